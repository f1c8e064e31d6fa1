"""K1-K2: corpus reports over analysed captures.

Both are plain aggregations with map-side partial aggregation, so hot keys (a
kind or tag carried by a third of all captures) are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kind_report(analyses: DataFrame) -> DataFrame:
    """K1: captures, failures and mean confidence by kind and save target, with subtotals."""
    return analyses.rollup("kind", "save_target").agg(
        F.grouping_id().alias("level"),
        F.count(F.lit(1)).alias("n_captures"),
        F.sum(F.col("error").cast("long")).alias("n_failed"),
        F.avg("confidence").alias("mean_confidence"),
    )


def tag_report(analyses: DataFrame) -> DataFrame:
    """K2: captures per tag and per risk flag (``dimension`` is ``tag`` or ``risk``)."""
    def named(dimension: str, values: str):
        return F.transform(F.array_distinct(values), lambda v: F.struct(F.lit(dimension).alias("dimension"), v.alias("value")))

    both = F.concat(named("tag", "tags"), named("risk", "risk_flags"))
    return analyses.select(F.explode(both).alias("x")).groupBy("x.dimension", "x.value").agg(F.count(F.lit(1)).alias("n_captures"))
