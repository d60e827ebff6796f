"""Samples, panels and identifiers of event files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Files that are compensation controls, not samples.
NOT_SAMPLES = re.compile(r"compensation|single[ _-]?stain|comp[ _-]?control", re.I)


def fingerprint_panels(channels: DataFrame, seen: str, sample: str = "sample_id", symbol: str = "symbol") -> DataFrame:
    """sample, marker_set and panel_i: samples of one marker set are one panel, numbered in order of first appearance."""
    s = channels.groupBy(sample).agg(F.array_join(F.array_sort(F.collect_set(symbol)), "|").alias("marker_set"), F.min(seen).alias("_first"))
    p = s.groupBy("marker_set").agg(F.min("_first").alias("_first"))
    # one row a panel
    n = p.select("marker_set", F.row_number().over(Window.orderBy("_first")).alias("panel_i"))
    return s.drop("_first").join(n, "marker_set").select(sample, "marker_set", "panel_i")


def sample_id(file: Column, keywords: Column) -> Column:
    """A well or sample keyword, else the leading well of the file name, else its stem."""
    base = F.regexp_extract(file, r"([^/\\]+)$", 1)
    named = [F.nullif(F.trim(F.try_element_at(keywords, F.lit(k))), F.lit("")) for k in ("$WELLID", "$SMNO", "WELL ID", "$SRC")]
    return F.coalesce(*named, F.nullif(F.regexp_extract(base, r"^([A-H][0-9]{1,2})", 1), F.lit("")), F.regexp_replace(base, r"(?i)[.]fcs$", ""))


def event_files(spark: SparkSession, path: str, recursive: bool = False, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """path and length of the event files of a folder, by Spark's own file listing (any store)."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", "length")
    f = f.filter(F.col("path").rlike(r"(?i)[.]fcs$")).filter(~F.col("path").rlike("(?i)" + (exclude or NOT_SAMPLES.pattern)))
    return f.filter(F.col("path").rlike(include)) if include else f


def date_batches(keywords: DataFrame, sample: str = "sample_id") -> DataFrame | None:
    """(sample, batch) from the $DATE keyword, if there is more than one date."""
    d = keywords.select(sample, F.try_element_at("keywords", F.lit("$DATE")).alias("batch"))
    return d if d.agg(F.count_distinct("batch")).first()[0] > 1 else None
