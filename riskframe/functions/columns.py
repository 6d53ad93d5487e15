"""Column-level helpers. All built-in Catalyst expressions (codegen, no UDFs)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(d) -> Column:
    """A date literal from str / date / Column (Columns pass through)."""
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    if isinstance(d, _dt.datetime):
        d = d.date()
    return F.lit(d.isoformat()).cast("date")


def ts_lit(t) -> Column:
    """A wall-clock timestamp literal (TIMESTAMP_NTZ: independent of the session time zone)."""
    if isinstance(t, Column):
        return t
    if isinstance(t, _dt.datetime):
        t = t.isoformat(sep=" ")
    return F.lit(str(t)).cast("timestamp_ntz")


def normalise_key(c) -> Column:
    """Strip + upper-case a symbol / pair."""
    return F.upper(F.trim(col_of(c)))


def to_number(c, fill=None, dtype: str = "double") -> Column:
    """Text to number, unparseable -> null (ANSI-safe), optional fill."""
    v = col_of(c).try_cast(dtype)
    return v if fill is None else F.coalesce(v, F.lit(fill).cast(dtype))


def split_pair(c) -> tuple[Column, Column]:
    """C9: 'USDGBP' -> ('USD', 'GBP')."""
    c = col_of(c)
    return F.substring(c, 1, 3), F.substring(c, 4, 3)


def valid_pair(c) -> Column:
    """An FX pair is six characters after trimming."""
    return F.length(F.trim(col_of(c))) == 6


def nan_to_null(c) -> Column:
    """NaN -> null at the serving edge."""
    c = col_of(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def round_or_null(c, digits: int) -> Column:
    """Dashboard rounding: falsy values (null and 0) come out as null."""
    c = col_of(c)
    return F.when(c != 0, F.round(c, digits))


def parse_symbols(text: str) -> list[str]:
    """Comma-separated universe, trimmed, blanks dropped (parameter parsing)."""
    return [s.strip() for s in text.split(",") if s.strip()]


def format_rows(df: DataFrame, sep: str = " | ") -> Column:
    """`col=val | col=val` text per row; nulls print as None."""
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("None")))
             for c in df.columns]
    return F.concat_ws(sep, *parts)
