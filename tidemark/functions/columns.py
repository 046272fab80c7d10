"""Small column builders shared by all operators. Everything stays a built-in JVM expression."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

AsOf = str | datetime | Column | None

# Fixed value: stands for NULL inside surrogate keys, so keys equal those already stored downstream.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"


def as_of_ts(as_of: AsOf) -> Column:
    """The evaluation instant. ``None`` means the wall clock; anything else is reproducible."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime):
        as_of = as_of.isoformat(sep=" ")
    return F.lit(as_of).cast("timestamp")


def as_of_date(as_of: AsOf | date) -> Column:
    if isinstance(as_of, date) and not isinstance(as_of, datetime):
        return F.lit(as_of)
    return as_of_ts(as_of).cast("date")


def ago(as_of: AsOf, amount: int, unit: str) -> Column:
    """``as_of`` minus ``amount`` days / hours / minutes."""
    return as_of_ts(as_of) - F.expr(f"make_dt_interval({_interval_args(amount, unit)})")


def _interval_args(amount: int, unit: str) -> str:
    slots = {"days": 0, "hours": 1, "minutes": 2}
    parts = ["0", "0", "0"]
    parts[slots[unit]] = str(int(amount))
    return ", ".join(parts)


def minutes_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(60e6)


def date_key(col: Column | str) -> Column:
    """Calendar key ``YYYYMMDD`` as INT."""
    return F.date_format(col, "yyyyMMdd").cast("int")


def hour_text(col: Column | str) -> Column:
    return F.date_format(col, "yyyyMMddHH")


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the dash-joined text of the parts, NULL parts replaced by a fixed token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL on a zero denominator (ANSI mode would raise)."""
    return numerator / F.nullif(denominator, F.lit(0))


def number(col: Column | str) -> Column:
    """DOUBLE view of a numeric column with NaN turned into NULL."""
    value = _col(col).cast("double")
    return F.when(~F.isnan(value), value)


def label_at_least(col: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first cut point that ``col`` reaches; cuts are given from high to low."""
    return _chain(((col >= cut, name) for cut, name in steps), otherwise)


def label_at_most(col: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first cut point that ``col`` does not exceed; cuts from low to high."""
    return _chain(((col <= cut, name) for cut, name in steps), otherwise)


def label_below(col: Column, steps: Sequence[tuple[float, str]], otherwise: str, missing: str) -> Column:
    """Label of the first cut point above ``col``; NULL gets its own label."""
    inside = _chain(((col < cut, name) for cut, name in steps), otherwise)
    return F.when(col.isNull(), F.lit(missing)).otherwise(inside)


def _chain(branches: Iterable[tuple[Column, str]], otherwise: str) -> Column:
    out = F
    for condition, name in branches:
        out = out.when(condition, F.lit(name))
    return out.otherwise(F.lit(otherwise))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema`` in its order: missing ones NULL, extra ones dropped, types cast."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def pick(col: Column, mapping: dict[str, Column], otherwise: Column) -> Column:
    """Choose a column by the value of another one."""
    out = F
    for key, value in mapping.items():
        out = out.when(col == F.lit(key), value)
    return out.otherwise(otherwise) if mapping else otherwise


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
