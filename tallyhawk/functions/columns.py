"""Column expressions shared by the operators (all built-in, codegen friendly)."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhawk.functions import constants as C


def ts_lit(value: str) -> Column:
    """A timestamp_ntz literal (wall clock, no time zone)."""
    return F.expr(f"TIMESTAMP_NTZ '{value}'")


def date_lit(value) -> Column:
    """A date literal from 'YYYY-MM-DD' text or a ``datetime.date``."""
    return F.lit(str(value)).cast("date")


def inf_date() -> Column:
    return date_lit(C.INF_DATE)


def inf_ts() -> Column:
    return ts_lit(C.INF_TS)


def as_col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def trunc_ms(col) -> Column:
    """Truncate a timestamp_ntz to whole milliseconds.

    Pure wall-clock arithmetic (the sub-millisecond part of the seconds field
    is subtracted), so the session time zone plays no part -- no DST gap can
    move the value.
    """
    c = as_col(col)
    sub_ms = (F.date_part(F.lit("SECOND"), c) * F.lit(1000000)) % F.lit(1000)
    return c - F.make_dt_interval(secs=(sub_ms / F.lit(1000000)).cast("decimal(18,6)"))


def shift(col, grain: str, steps: int = 1) -> Column:
    """Move a validity bound by ``steps`` grains; grain is 'day' or 'ms'."""
    c = as_col(col)
    if grain == "day":
        return F.date_add(c, steps)
    if grain == "ms":
        sign = "-" if steps < 0 else ""
        return c + F.expr(f"INTERVAL '{sign}{abs(steps)}' MILLISECOND")
    raise ValueError(f"unknown grain {grain!r}")


def infinity(grain: str) -> Column:
    return inf_date() if grain == "day" else inf_ts()


def validity_start(update_col=C.UPDATE_COL, create_col=C.CREATE_COL) -> Column:
    """Version start: the update time when there is one, else the creation time."""
    return F.coalesce(as_col(update_col), as_col(create_col))


def null_safe_changed(pairs: Iterable[tuple]) -> Column:
    """True when any (old, new) pair differs, treating NULL = NULL as equal."""
    terms = [~as_col(old).eqNullSafe(as_col(new)) for old, new in pairs]
    if not terms:
        return F.lit(False)
    return reduce(lambda a, b: a | b, terms)


def normalize_amount(col, scale: int = 2) -> Column:
    """Text amount with a decimal comma -> decimal(18, scale)."""
    return F.regexp_replace(as_col(col), ",", ".").cast(f"decimal(18,{scale})")


def file_name_date(col) -> Column:
    """First 8-digit group of a file name (DDMMYYYY) -> date; NULL when the
    name has none or it is not a valid date (never raises in ANSI mode)."""
    return F.try_to_date(F.regexp_extract(as_col(col), C.FILE_DATE_REGEX, 1), C.FILE_DATE_FORMAT)


def fio(last="last_name", first="first_name", patronymic="patronymic") -> Column:
    """Full name 'last first patronymic'; NULL when any part is NULL."""
    return F.concat(as_col(last), F.lit(" "), as_col(first), F.lit(" "), as_col(patronymic))


def is_open(to_col=C.TO_COL, grain: str = "ms") -> Column:
    return as_col(to_col) == infinity(grain)


def is_live(flag_col=C.FLAG_COL) -> Column:
    return as_col(flag_col) == F.lit(C.LIVE)


def valid_at(ts, from_col=C.FROM_COL, to_col=C.TO_COL, grain: str = "ms") -> Column:
    """``ts`` lies in [from, to]; for DATE-grain versions the day of ``ts`` is compared."""
    t = as_col(ts)
    if grain == "day":
        t = F.to_date(t)
    return t.between(as_col(from_col), as_col(to_col))


def epoch_seconds(col) -> Column:
    """Whole seconds since 1970-01-01 of a wall-clock timestamp (time-zone free)."""
    c = as_col(col)
    return (
        F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long") * 86400
        + F.hour(c) * 3600
        + F.minute(c) * 60
        + F.second(c)
    )
