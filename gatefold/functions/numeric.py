"""Column expressions that operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) and not c.startswith("`") and "." not in c else (F.col(c) if isinstance(c, str) else c)


def finite(c: Column | str) -> Column:
    """True for numbers; false for null, NaN and infinities."""
    x = col(c)
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def asinh_scaled(c: Column | str, cofactor: float | Column) -> Column:
    """asinh(x / cofactor).  The sign is split off: asinh of large negatives loses its digits."""
    x = col(c)
    return F.signum(x) * F.asinh(F.abs(x) / cofactor)


def sinh_scaled(c: Column | str, cofactor: float | Column) -> Column:
    return F.sinh(col(c)) * cofactor


def log10_floor(c: Column | str, floor: float = 1.0) -> Column:
    return F.log10(F.greatest(col(c), F.lit(floor)))


def logistic(c: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-c))


def norm_id(c: Column | str) -> Column:
    """Identifiers compare without case and surrounding blanks."""
    return F.upper(F.trim(col(c)))


def all_of(parts: list[Column], default: bool = True) -> Column:
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(default)


def any_of(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)


def p_stars(p: Column | str) -> Column:
    """Significance marks; a p in [0.05, 0.10) is written out as a trend."""
    x = col(p)
    return (
        F.when(~finite(x), F.lit("")).when(x < 0.0001, "****").when(x < 0.001, "***").when(x < 0.01, "**").when(x < 0.05, "*")
        .when(x < 0.10, F.format_string("p: %.4f", x)).otherwise("ns")
    )


def pretty_label(c: Column | str) -> Column:
    """Underscores as blanks, first letter upper case."""
    x = F.regexp_replace(col(c), "_+", " ")
    return F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 20))


def functional_key(block: str = "block", population: str = "population", marker: str = "marker") -> Column:
    """The panel of a functional marker: "block: population, marker"."""
    return F.concat(col(block), F.lit(": "), col(population), F.lit(", "), col(marker))


def state_key(population: str = "population", marker: str = "marker") -> Column:
    """The panel of a marker of a population: "population, marker"."""
    return F.concat(col(population), F.lit(", "), col(marker))
