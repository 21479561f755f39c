"""Null-aware scalar and array expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def missing_to_null(c: Column) -> Column:
    """NaN means missing in the source data; SQL has NULL for it."""
    return F.when(~F.isnan(c), c)


def clip(c: Column, lo: float, hi: float) -> Column:
    """``c`` held within [lo, hi]; null stays null."""
    return F.when(c.isNotNull(), F.least(F.lit(hi), F.greatest(F.lit(lo), c)))


def ratio(n: Column, d: Column, otherwise: float) -> Column:
    """n / d, or ``otherwise`` where d is 0."""
    return F.when(d != 0, n / d).otherwise(F.lit(otherwise))


def row_mean(*columns: Column) -> Column:
    """Mean of the columns that aren't null; null if all are."""
    total = reduce(add, (F.coalesce(c, F.lit(0.0)) for c in columns))
    return F.try_divide(total, reduce(add, (c.isNotNull().cast("int") for c in columns)))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalised(v: Column, least: float = 1e-8) -> Column:
    """``v`` at length 1; shorter ones than ``least`` are divided by that."""
    length = F.greatest(norm(v), F.lit(least))
    return F.transform(v, lambda x: x.cast("double") / length)


def quaternion_step(q: Column, p: Column) -> Column:
    """Angle between two unit quaternions, whose signs don't count."""
    return 2 * F.acos(F.least(F.lit(1.0), F.abs(dot(q, p))))


def linspace(lo: Column, hi: Column, n: int) -> Column:
    """n whole numbers from lo to hi, evenly spaced and truncated, the last exactly hi."""
    step = (hi - lo) / F.lit(n - 1.0)
    at = lambda i: F.when(i == n - 1, hi).otherwise(lo + i * step)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: at(i).cast("long"))


def object_path(c: Column) -> Column:
    """An object key: bucket scheme, and slashes at either end, removed."""
    return F.regexp_replace(F.regexp_replace(F.trim(c), r"^[a-z0-9]+://[^/]+/", ""), r"^/+|/+$", "")


def is_episode_key(c: Column) -> Column:
    return c.rlike(r"\A[0-9a-f]{24}\z")


def split_flags(c: Column) -> Column:
    return F.filter(F.split(c, "[+]"), lambda x: x != "")


def _printed(c: Column, form: str) -> Column:
    """A double as text by its exact value, as C and ECMAScript round it: ``format_string`` rounds the
    shortest decimals that stand for it, so that 1.355, which is a little less, becomes 1.36."""

    @F.pandas_udf("string")
    def text(x: pd.Series) -> pd.Series:
        return pd.Series([format(v, form).replace("nan", "NaN").replace("inf", "Infinity") for v in x])

    return text(c.cast("double"))


def fixed(c: Column, digits: int = 3) -> Column:
    """A number as text, or a dash."""
    return F.when(c.isNotNull(), _printed(c, f".{digits}f")).otherwise("—")


def exponential(c: Column, digits: int = 2) -> Column:
    """A number as text with an exponent without leading zeros, or a dash."""
    return F.when(c.isNotNull(), F.regexp_replace(_printed(c, f".{digits}e"), r"e([+-])0(?=[0-9])", "e$1")).otherwise("—")


def bar_is_bad(z: Column, limit: float = 1.25) -> Column:
    return F.coalesce(z, F.lit(0.0)) > limit


def bar_percent(z: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), (F.coalesce(z, F.lit(0.0)) + 4) / 8 * 100))
