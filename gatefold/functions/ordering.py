"""Places of rows in an order, by a range partitioning: no task holds a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatefold.functions.storage import cut


def places(df: DataFrame, groups: list[str], order: list[str], name: str = "place") -> DataFrame:
    """df with the place (from 0) of each row in its group; order should tell rows apart.

    Rows are sorted by a range partitioning and written; the place of a row is that in its partition plus the sizes of its group's
    runs in partitions before, a table of partitions and groups.
    """
    by = [F.col(c).asc_nulls_first() for c in (*groups, *order)]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_p_m", F.monotonically_increasing_id()).withColumn("_p_part", F.shiftright("_p_m", 33))
    ranged = cut(ranged, "ranged")
    runs = ranged.groupBy(*groups, "_p_part").agg(F.min("_p_m").alias("_p_first"), F.count(F.lit(1)).alias("_p_c"))
    before = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(1))).orderBy("_p_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_p_at", F.coalesce(F.sum("_p_c").over(before), F.lit(0)) - F.col("_p_first"))
    runs = runs.select(*[F.col(g).alias(f"_p_g{i}") for i, g in enumerate(groups)], F.col("_p_part").alias("_p_of"), "_p_at")
    match = F.col("_p_part") == F.col("_p_of")
    for i, g in enumerate(groups):
        match = match & F.col(g).eqNullSafe(F.col(f"_p_g{i}"))
    return ranged.join(runs, match).withColumn(name, F.col("_p_m") + F.col("_p_at")).select(*df.columns, name)
