"""Input contract checks on the fixture views and on broken inputs."""
from capsight.plans.checks import duplicate_positions, repeated_attempts, turn_gaps
from capsight.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_fixture_views_meet_the_contracts(spark):
    assert duplicate_positions(fx.captures(spark, SF)).count() == 0
    assert turn_gaps(fx.messages(spark, SF)).count() == 0
    assert repeated_attempts(fx.attempts(spark, SF)).count() == 0


def test_checks_find_violations(spark):
    msgs = spark.createDataFrame([(1, 0), (1, 2), (2, 0), (2, 1)], "conv_id long, turn long")
    assert [r.conv_id for r in turn_gaps(msgs).collect()] == [1]
    caps = spark.createDataFrame([(1, 0), (1, 0), (1, 1)], "group_id long, pos int")
    assert duplicate_positions(caps).count() == 1
