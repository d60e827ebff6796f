"""Driver tables in the roles of the engine: samples, groups, markers, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cells(spark: SparkSession, sf: str, also: tuple[str, ...] = ()) -> DataFrame:
    """lineitem as cells: nations are samples, regions are groups, m1 has two modes, m2 to m4 one; also: further columns of lineitem."""
    t = lambda n: table(spark, sf, n)
    li = t("lineitem").join(t("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    li = li.join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    shift = F.when(F.col("l_returnflag") == "R", 3.0).otherwise(0.0)
    return li.select(
        F.col("n_name").alias("sample_id"), F.col("r_name").alias("grp"), F.round(F.log("l_extendedprice") + shift, 9).alias("m1"), F.col("l_quantity").alias("m2"),
        F.round(F.col("l_discount") * 100, 6).alias("m3"), F.round(F.col("l_tax") * 100, 6).alias("m4"), F.col("l_returnflag").alias("rf"), F.col("l_linestatus").alias("ls"), *also,
    )


CELLS_SQL = """cells AS (
  SELECT n_name AS sample_id, r_name AS grp, round(ln(l_extendedprice) + CASE WHEN l_returnflag = 'R' THEN 3.0 ELSE 0.0 END, 9) AS m1, l_quantity AS m2,
         round(l_discount * 100, 6) AS m3, round(l_tax * 100, 6) AS m4, l_returnflag AS rf, l_linestatus AS ls
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def supplier_values(spark: SparkSession, sf: str) -> DataFrame:
    """One row a supplier: sample_id, group (its region), value (median price) and qty (mean quantity)."""
    t = lambda n: table(spark, sf, n)
    s = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", F.col("r_name").alias("group"))
    v = t("lineitem").groupBy("l_suppkey").agg(F.round(F.percentile("l_extendedprice", F.lit(0.5)), 4).alias("value"), F.round(F.avg("l_quantity"), 6).alias("qty"))
    return v.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_suppkey").alias("sample_id"), "group", "value", "qty")


SUPPLIER_SQL = """sv AS (
  SELECT l_suppkey AS sample_id, r_name AS grp, value, qty
  FROM (SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.5), 4) AS value, round(avg(l_quantity), 6) AS qty FROM lineitem GROUP BY 1)
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def embedding_columns(spark: SparkSession, sf: str, n: int = 8) -> DataFrame:
    """embeddings with their first n coordinates as columns e0, e1, ..."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.col("label").alias("label"), *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(n)])
