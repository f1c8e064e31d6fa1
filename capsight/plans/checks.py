"""Input contract checks: each returns the violating keys (empty when the input is fine).

All are single aggregations with map-side combine; results stay distributed
(inspect them with ``.limit(n)``, count them, or write them out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_positions(handoffs: DataFrame) -> DataFrame:
    """``(group_id, pos)`` pairs held by more than one member (compare needs them unique)."""
    return handoffs.groupBy("group_id", "pos").count().where(F.col("count") > 1)


def turn_gaps(messages: DataFrame) -> DataFrame:
    """Conversations whose turns are not 0..n-1 (``with_positions`` numbers them)."""
    g = messages.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("first_turn"),
                                        F.max("turn").alias("last_turn"),
                                        F.count_distinct("turn").alias("distinct_turns"))
    return g.where((F.col("first_turn") != 0) | (F.col("last_turn") != F.col("n") - 1)
                   | (F.col("distinct_turns") != F.col("n")))


def repeated_attempts(attempts: DataFrame) -> DataFrame:
    """``(capture_id, provider)`` pairs with more than one attempt (``attempt_no`` orders them)."""
    return attempts.groupBy("capture_id", "provider").count().where(F.col("count") > 1)
