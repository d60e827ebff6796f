"""Sample maps, patient tables, absolute counts, external labels and configuration."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatefold.functions.numeric import norm_id
from gatefold.sources.defaults import HEADERS, VALUES

#: Default covariates by the names that the loader gives them.
COVARIATES = {"age": "age_years"}


def norm_header(h: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", h.strip().lower()).strip("_")


def sniff(first_line: str) -> str:
    return ";" if first_line.count(";") > first_line.count(",") else ","


def read_table(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """A CSV with ; or , as its first line has it, all columns as text; UTF-8, or latin1 where the file isn't that."""
    if encoding is None:
        odd = spark.read.text(path).filter(~F.is_valid_utf8("value")).limit(1).count()
        encoding = "ISO-8859-1" if odd else "UTF-8"
    head = spark.read.text(path).limit(1).collect()
    sep = sniff(head[0][0]) if head else ","
    return spark.read.options(header=True, sep=sep, encoding=encoding).csv(path)


def decimal(c: str) -> Column:
    """A number that may have a decimal comma; null if it isn't one."""
    return F.regexp_replace(F.trim(F.col(c)), ",", ".").try_cast("double")


def parse_dates(df: DataFrame, column: str, reference: dt.date | None = None, out: str | None = None) -> DataFrame:
    """Dates of a text column: ISO first; D/M or M/D is decided over the whole column (a first part over 12 means D/M,
    a second part over 12 with no such first part means M/D); two-digit years are never after the reference date."""
    ref = reference or dt.date.today()
    t = F.trim(F.col(f"`{column}`"))
    pat = r"^(\d{1,2})[./-](\d{1,2})[./-](\d{4}|\d{2})$"
    a, b, y = (F.regexp_extract(t, pat, i).try_cast("int") for i in (1, 2, 3))
    probe = df.agg((F.max(a) > 12).alias("_dm"), (F.max(b) > 12).alias("_md"))
    d = df.join(F.broadcast(probe))  # one row
    month_first = F.coalesce(F.col("_md"), F.lit(False)) & ~F.coalesce(F.col("_dm"), F.lit(False))
    century = F.when(F.length(F.regexp_extract(t, pat, 3)) == 4, y).when(y + 2000 > ref.year, y + 1900).otherwise(y + 2000)
    day, month = F.when(month_first, b).otherwise(a), F.when(month_first, a).otherwise(b)
    text = F.format_string("%04d-%02d-%02d", century, month, day)
    named = [F.try_to_date(t, f) for f in ("d MMM yyyy", "d MMMM yyyy", "MMM d yyyy", "MMMM d, yyyy")]
    iso = F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), t.try_cast("date"))
    got = F.coalesce(iso, F.when(t.rlike(pat), text.try_cast("date")), *named)
    return d.withColumn(out or column, got).drop("_dm", "_md")


def translate(column: str, table: dict[str, str]) -> Column:
    """Values by dictionary, without case; compounds (/ , + 'und') token by token, a final ? becomes "(uncertain)".

    A value of which no token is known passes through unchanged.
    """
    known = F.create_map(*[F.lit(x) for k, v in table.items() for x in (k.strip().lower(), v)])
    look = lambda t: F.try_element_at(known, F.lower(t))
    s = F.trim(F.col(column))
    core = F.trim(F.regexp_replace(s, r"\?\s*$", ""))
    tokens = F.filter(F.transform(F.split(core, r"\s*[/,+]\s*|\s+und\s+"), lambda t: F.trim(t)), lambda t: t != "")
    some = F.exists(tokens, lambda t: look(t).isNotNull())
    joined = F.concat(F.array_join(F.transform(tokens, lambda t: F.coalesce(look(t), t)), " / "), F.when(s.rlike(r"\?\s*$"), " (uncertain)").otherwise(""))
    return F.coalesce(look(s), F.when(some, joined), s)


def load_patients(spark: SparkSession, path: str, reference: dt.date | None = None, headers: dict[str, list[str]] | None = None, values: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """patient_id, cohort, age_years, sex and other known columns; unknown columns are left out.

    Heights and weights of 0 or less are null; an age that is missing comes from the date of birth.
    """
    raw = read_table(spark, path)
    known = headers or HEADERS
    at = {norm_header(c): c for c in reversed(raw.columns)}
    have = {k: at[norm_header(s)] for k, names in known.items() for s in reversed(names) if norm_header(s) in at}
    d = raw.select(*[F.col(f"`{c}`").alias(k) for k, c in have.items()])
    for c in ("age_years", "height_cm", "weight_kg", "wbc_per_ul"):
        if c in have:
            d = d.withColumn(c, decimal(c))
    for c in ("height_cm", "weight_kg"):
        if c in have:
            d = d.withColumn(c, F.when(F.col(c) > 0, F.col(c)))
    if "date_of_birth" in have:
        d = parse_dates(d, "date_of_birth", reference)
        age = F.floor(F.datediff(F.lit(reference or dt.date.today()), "date_of_birth") / 365.25)
        d = d.withColumn("age_years", F.coalesce(F.col("age_years"), age) if "age_years" in have else age.cast("double"))
    for c, table in (values or VALUES).items():
        if c in have:
            d = d.withColumn(c, translate(c, table))
    return d.filter(F.trim("patient_id") != "")


def completeness(df: DataFrame) -> DataFrame:
    """column, n_present, n: how full each column is."""
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    return one.select("n", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("n_present")) for i, c in enumerate(df.columns)])).alias("r")).select("r.*", "n")


class SampleMapError(ValueError):
    pass


def load_sample_map(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """file, sample_id, patient_id, is_control and others; a missing, repeated or uncovered file is an error."""
    d = read_table(spark, path)
    d = d.toDF(*[c.strip().lower() for c in d.columns])
    if "file" not in d.columns:
        raise SampleMapError("the sample map needs a column 'file'")
    d = d.withColumn("file", F.regexp_extract(F.trim("file"), r"([^/\\]+)$", 1))
    if "sample_id" not in d.columns:
        d = d.withColumn("sample_id", F.regexp_replace("file", r"(?i)[.]fcs$", ""))
    twice = [r[0] for r in d.groupBy("file").count().filter("count > 1").select("file").limit(5).collect()]
    if twice:
        raise SampleMapError(f"files twice in the sample map: {twice}")
    if files is not None:
        gone = [r[0] for r in files.select("file").join(d.select("file"), "file", "left_anti").limit(5).collect()]
        if gone:
            raise SampleMapError(f"files without a row in the sample map: {gone}")
    if "is_control" in d.columns:
        d = d.withColumn("is_control", truth("is_control"))
    return d


def truth(column: str) -> Column:
    """Whether a cell says yes; nothing, or anything else, is no."""
    return F.coalesce(F.lower(F.trim(F.col(column).cast("string"))).isin("true", "t", "1", "yes", "y"), F.lit(False))


def sample_map_template(files: DataFrame) -> DataFrame:
    return files.select("file", F.regexp_replace("file", r"(?i)[.]fcs$", "").alias("sample_id"), *[F.lit("").alias(c) for c in ("patient_id", "timepoint", "is_control", "well", "panel")])


def group_of(smap: DataFrame, patients: DataFrame, column: str) -> DataFrame:
    """sample_id and group: a column of the patient table, through the sample map; blank values are no group."""
    p = patients.select(norm_id("patient_id").alias("_k"), F.col(column).cast("string").alias("group")).filter("group is not null and group <> ''")
    return smap.filter("sample_id is not null").select("sample_id", norm_id("patient_id").alias("_k")).join(p, "_k").select("sample_id", "group")


def batch_of(column: str, smap: DataFrame, patients: DataFrame | None = None, keywords: DataFrame | None = None) -> DataFrame | None:
    """sample_id and batch: a column of the sample map, else of the patient table, else the acquisition date if there are several."""
    if column in smap.columns:
        return smap.select("sample_id", F.col(column).cast("string").alias("batch"))
    if patients is not None and column in patients.columns and "patient_id" in smap.columns:
        return group_of(smap, patients, column).withColumnRenamed("group", "batch")
    if keywords is not None:
        from gatefold.sources.events import date_batches

        return date_batches(keywords)
    return None


def attach_patients(df: DataFrame, smap: DataFrame, patients: DataFrame, sample: str = "sample_id") -> DataFrame:
    """df with its sample's patient columns; ids compare without case and blanks, the patient table's spelling wins."""
    s = smap.select(F.col("sample_id").alias("_s"), norm_id("patient_id").alias("_k"))
    p = patients.withColumn("_k", norm_id("patient_id"))
    return df.join(s.join(p, "_k", "left").drop("_k"), df[sample] == F.col("_s"), "left").drop("_s")


# ---------------------------------------------------------------- absolute counts
def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of a workbook, its first row as header, all cells as text.  A count sheet is small; it is read on the driver."""
    import io
    import zipfile
    from xml.etree import ElementTree as ET

    raw = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    tag = lambda e: e.tag.rsplit("}", 1)[-1]
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = z.namelist()
        shared = ["".join(t.text or "" for t in si.iter() if tag(t) == "t") for si in ET.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        sheet = ET.fromstring(z.read(min((n for n in names if re.match(r"xl/worksheets/sheet\d+[.]xml$", n)), key=lambda n: int(re.search(r"\d+", n).group()))))

    def place(ref: str) -> int:
        at = 0
        for c in re.match("[A-Z]+", ref).group():
            at = at * 26 + ord(c) - 64
        return at - 1

    def text(c) -> str | None:
        v = next((e.text for e in c.iter() if tag(e) in ("v", "t")), None)
        return shared[int(v)] if c.get("t") == "s" and v is not None else v

    rows = [{place(c.get("r")): text(c) for c in r if tag(c) == "c"} for r in sheet.iter() if tag(r) == "row"]
    width = 1 + max((k for r in rows for k in r), default=-1)
    table = [[r.get(k) for k in range(width)] for r in rows]
    header = [h or f"column_{k}" for k, h in enumerate(table[0])] if table else []
    return spark.createDataFrame(table[1:], ", ".join(f"`{h}` string" for h in header))


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """sample_key, population, cells_per_ul of a count table, CSV or workbook; the first column names the sample."""
    d = read_xlsx(spark, path) if path.lower().endswith(".xlsx") else read_table(spark, path)
    return unpivot_counts(d, d.columns[0])


def unpivot_counts(df: DataFrame, sample: str) -> DataFrame:
    """(sample_key, population, cells_per_ul) of a wide table of text cells.

    A column is a population if any cell is a number; others tell the unit: per mL is divided by 1000, per uL
    and no unit at all are taken as they are.
    """
    cols = [c for c in df.columns if c != sample]
    seen = df.agg(*[F.max(decimal(c).isNotNull()).alias(c) for c in cols]).first() if cols else {}
    pops = [c for c in cols if seen[c]]
    unit = " ".join(c for c in cols if not seen[c])
    scale = 0.001 if re.search(r"ml\b", unit, re.I) and not re.search(r"[uµ]l\b", unit, re.I) else 1.0
    d = df.filter(F.trim(F.col(f"`{sample}`")) != "").select(F.col(f"`{sample}`").alias("sample_key"), F.explode(F.array(*[F.struct(F.lit(c).alias("population"), (decimal(c) * scale).alias("cells_per_ul")) for c in pops])).alias("r"))
    return d.select("sample_key", "r.*").filter("cells_per_ul is not null")


def match_counts(counts: DataFrame, smap: DataFrame) -> DataFrame:
    """counts with sample_id: by patient id, else by a file name that ends in the key after a delimiter; ambiguous keys go."""
    keys = counts.select("sample_key").distinct()
    by_patient = keys.join(smap.select("sample_id", norm_id("patient_id").alias("_k")), norm_id("sample_key") == F.col("_k")).select("sample_key", "sample_id", F.lit(1).alias("how"))
    stem = F.upper(F.regexp_replace("file", r"(?i)[.]fcs$", ""))
    k = norm_id(F.regexp_replace("sample_key", r"(?i)[.]fcs$", ""))
    # the stem and what follows each of its delimiters, so that keys meet files by equality
    tails = lambda s: F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda i: F.substring(s, i, F.lit(1)).isin("_", " ", "-")), lambda i: F.substring(s, i + 1, F.length(s)))
    ends = smap.select("sample_id", stem.alias("_s")).select("sample_id", F.explode(F.array_distinct(F.concat(F.array("_s"), tails(F.col("_s"))))).alias("_k"))
    by_file = keys.withColumn("_k", k).join(ends.filter("_k <> ''"), "_k").select("sample_key", "sample_id", F.lit(2).alias("how"))
    both = by_patient.unionByName(by_file)
    first = both.groupBy("sample_key").agg(F.min("how").alias("how"))
    hits = both.join(first, ["sample_key", "how"])
    one = hits.groupBy("sample_key").agg(F.count_distinct("sample_id").alias("n"), F.first("sample_id").alias("sample_id")).filter("n = 1").drop("n")
    return counts.join(one, "sample_key").select("sample_id", "population", "cells_per_ul")


def absolute_from_wbc(freq: DataFrame, wbc: DataFrame, sample: str = "sample_id") -> DataFrame:
    """freq with cells_per_ul: the population's share of a leukocyte count (sample, wbc_per_ul)."""
    return freq.join(wbc.select(sample, "wbc_per_ul"), sample, "left").withColumn("cells_per_ul", F.col("pct_of_cd45_pos") / 100.0 * F.col("wbc_per_ul")).drop("wbc_per_ul")


# ---------------------------------------------------------------- labels and configuration
LABEL_COLUMNS = {"sample_id": ("sample_id", "sample", "file", "expfcs_filename"), "event_index": ("event_index", "event", "event_id", "cell_id"), "external_label": ("external_label", "label", "cluster", "metacluster", "population")}


def read_labels(spark: SparkSession, path: str, **columns: str) -> DataFrame:
    """sample_id, event_index and external_label by the usual header names or the given ones."""
    d = read_table(spark, path)
    at = {norm_header(c): c for c in reversed(d.columns)}
    out = {}
    for k, names in LABEL_COLUMNS.items():
        c = columns.get(k) or next((at[n] for n in names if n in at), None)
        if c is None or c not in d.columns:
            raise ValueError(f"no column for {k} among {d.columns}")
        out[k] = F.col(f"`{c}`")
    return d.select(out["sample_id"].alias("sample_id"), out["event_index"].cast("long").alias("event_index"), out["external_label"].alias("external_label"))


@dataclass(frozen=True)
class RunConfig:
    """What a run is told; analyses that change no number are on by default."""

    populations: dict = field(default_factory=dict)
    functional_blocks: dict = field(default_factory=dict)
    ratios: dict = field(default_factory=dict)
    thresholds: dict = field(default_factory=dict)
    transform: str = "arcsinh"
    cofactor: float | None = None
    singlet_mad_k: float = 3.0
    min_cd45_pct: float = 5.0
    include_qc_failed: bool = False
    viability_marker: str | None = None
    group_column: str = "cohort"
    reference_group: str | None = None
    covariates: tuple[str, ...] = ("age", "sex")
    cells_per_sample: int = 20_000
    max_cells: int = 200_000
    seed: int = 42
    uncertainty_boot: int = 100
    uncertainty_max_events: int = 20_000
    correct_batch: bool = False
    batch_max_cramers_v: float = 0.6
    force_batch_correction: bool = False
    fail_on_drift: bool = False
    pool_samples: int = 8
    min_cells: int = 20
    min_group_n: int = 3
    pair_column: str | None = None
    condition_column: str | None = None
    reference_condition: str | None = None
    batch_column: str | None = None
    uncertainty: bool = True
    embedding: bool = True
    clusters: bool = True
    n_clusters: int = 12
    som_side: int = 10
    subclusters: bool = True
    n_neighbors: int = 30
    min_dist: float = 0.3
    umap_epochs: int = 200
    mixing_k: int = 30
    mixing_permutations: int = 20
    explain_clusters: bool = True
    max_explained: int = 4
    explain_max_depth: int = 4
    external_max_labels: int = 6
    differential_state: bool = True
    heatmaps: bool = True
    compositional: bool = True
    confounding: bool = True
    threshold_drift: bool = True
    figures: bool = True
    external_labels_min_match: int = 100
    export_fcs: bool = False
    export_gating_ml: bool = True
    colors: dict = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | Path) -> RunConfig:
        d = yaml.safe_load(Path(path).read_text()) or {}
        flat = {k: v for k, v in d.items() if k in cls.__dataclass_fields__}
        for part in ("gating", "metadata"):
            flat |= {k: v for k, v in (d.get(part) or {}).items() if k in cls.__dataclass_fields__}
        for k in ("ratios",):
            if isinstance(flat.get(k), dict):
                flat[k] = {n: tuple(v.values()) if isinstance(v, dict) else tuple(v) for n, v in flat[k].items()}
        return cls(**flat)

    def save(self, path: str | Path, thresholds: list[dict] | None = None) -> None:
        """YAML with the thresholds of a run: the first sample's for each marker."""
        d = {k: getattr(self, k) for k in self.__dataclass_fields__ if getattr(self, k) not in (None, {})}
        d = {k: list(v) if isinstance(v, tuple) else v for k, v in d.items()}
        if thresholds:
            seen: dict = {}
            for t in thresholds:
                seen.setdefault(t["marker"], {"threshold": float(t["threshold"]), "source": t["source"], "needs_review": bool(t["needs_review"])})
            d["thresholds"] = seen
        d["ratios"] = {k: list(v) for k, v in self.ratios.items()}
        Path(path).write_text(yaml.safe_dump(d, sort_keys=False))

    def threshold_rows(self) -> list[tuple[str, float]]:
        return [(m, float(v["threshold"] if isinstance(v, dict) else v)) for m, v in self.thresholds.items()]
