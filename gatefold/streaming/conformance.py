"""Drift of landing samples against a baseline, as a stream.  An addition of this library.

Each sample and marker keeps a histogram of what has landed of it, BINS counts on a fixed scale, as keyed state; files of a sample may land in any
number of batches.  A batch adds its events' counts, partially aggregated before they meet the state, finds the cut of the
histogram so far and joins it with the baseline.  State is as large as samples times markers times BINS, whatever the events.  With `keep`,
a sample that brings nothing for so long is dropped from it; Spark then runs batches without data as well, so that suits a
trigger by time and not one that ends with what is there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gatefold.functions.numeric import col, finite
from gatefold.operators.conformance import verdict
from gatefold.operators.uncertainty import valley_of
from gatefold.operators.valley import Valley

#: Scale of transformed intensities that histograms span; values beyond count in the outer bins.
LOW, HIGH, BINS = -4.0, 16.0, 8000


def place(value):
    """The bin of a value."""
    x = col(value).cast("double")
    return F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((x - LOW) / (HIGH - LOW) * BINS))).cast("int")


def running_cuts(events: DataFrame, markers: list[str], sample: str = "sample_id", panel: str | None = None, settings: Valley = Valley(), keep: str | None = None) -> DataFrame:
    """sample, panel, marker, n and cut (null while there is none) after every batch that brings events of a sample.

    events: a stream of transformed events.  Rows that aren't finite don't count.
    """
    who = F.col(panel).cast("string") if panel else F.lit("panel_1")
    pairs = F.array(*[F.struct(F.lit(m).alias("marker"), col(m).cast("double").alias("x")) for m in markers])
    long = events.select(F.col(sample).cast("string").alias("sample_id"), who.alias("panel"), F.explode(pairs).alias("r")).select("sample_id", "panel", "r.*").filter(finite("x"))
    rows = long.select("sample_id", "panel", "marker", place("x").alias("bin"))
    ms = int(pd.Timedelta(keep).total_seconds() * 1000) if keep else 0

    def add(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        counts = np.frombuffer(state.get[0], np.int64).copy() if state.exists else np.zeros(BINS, np.int64)
        for p in parts:
            counts += np.bincount(p["bin"].to_numpy(), minlength=BINS)
        state.update((counts.tobytes(),))
        if ms:
            state.setTimeoutDuration(ms)
        v, _ = valley_of(counts, settings)
        yield pd.DataFrame({"sample_id": [key[0]], "panel": [key[1]], "marker": [key[2]], "n": [int(counts.sum())], "cut": [None if v is None else LOW + (HIGH - LOW) / BINS * v]}).astype({"cut": "float64"})

    return rows.groupBy("sample_id", "panel", "marker").applyInPandasWithState(add, "sample_id string, panel string, marker string, n long, cut double", "counts binary", "update", GroupStateTimeout.ProcessingTimeTimeout if keep else GroupStateTimeout.NoTimeout)


def against_baseline(cuts: DataFrame, baseline: DataFrame, qualify: float = 3.5, fail: float = 6.0, floor: float = 0.25) -> DataFrame:
    """cuts with the baseline's threshold of the same panel and marker, robust_z and verdict: a stream-static join.

    baseline: panel, marker, median_threshold and mad_threshold, as a run writes it, one row a panel and marker.
    """
    b = baseline.select("panel", "marker", F.col("median_threshold").alias("baseline_threshold"), F.col("mad_threshold").alias("baseline_mad"))
    z = F.abs(F.col("cut") - F.col("baseline_threshold")) / F.greatest("baseline_mad", F.lit(floor))
    # as many rows as panels have markers
    return cuts.join(F.broadcast(b), ["panel", "marker"], "left").withColumn("robust_z", F.bround(z, 2)).withColumn("verdict", verdict(z, qualify, fail)).drop("baseline_mad")
