"""Date/time column expressions. Session time zone is UTC; ``as_of`` is one literal per job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY_MICROS = 86_400_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_ts(as_of: str) -> Column:
    """The run's single timestamp literal ('YYYY-MM-DD HH:MM:SS', UTC)."""
    return F.lit(as_of).cast("timestamp")


def parse_iso(c) -> Column:
    """ISO-8601 text (``Z``, offsets, fractions) -> TIMESTAMP; empty/junk -> NULL."""
    return F.try_to_timestamp(F.nullif(_c(c), F.lit("")))


def elapsed_days(ts, as_of: str) -> Column:
    """Whole elapsed 24 h periods from ``ts`` to as_of, min 0; NULL -> 0 (D1). Not a calendar diff."""
    diff = F.unix_micros(as_of_ts(as_of)) - F.unix_micros(_c(ts))
    return F.coalesce(F.greatest(F.lit(0), (diff / F.lit(_DAY_MICROS)).cast("long")), F.lit(0)).cast("int")


def days_remaining(finish_ts, as_of: str) -> Column:
    """Calendar days from as_of's date to the finish date, min 0; no finish -> 0."""
    d = F.datediff(F.to_date(_c(finish_ts)), F.to_date(as_of_ts(as_of)))
    return F.coalesce(F.greatest(F.lit(0), d), F.lit(0)).cast("int")


def total_days(start_ts, finish_ts) -> Column:
    """Calendar sprint length, min 1, 0 unless both dates are set (D3)."""
    d = F.datediff(F.to_date(_c(finish_ts)), F.to_date(_c(start_ts)))
    return F.when(_c(start_ts).isNotNull() & _c(finish_ts).isNotNull(), F.greatest(F.lit(1), d)).otherwise(F.lit(0)).cast("int")


def is_on_as_of_date(ts, as_of: str) -> Column:
    """Same UTC calendar date as as_of."""
    return F.to_date(_c(ts)) == F.to_date(as_of_ts(as_of))


def display_datetime(ts) -> Column:
    """'dd MMM yyyy, hh:mm AM UTC' (D9)."""
    return F.date_format(_c(ts), "dd MMM yyyy, hh:mm a 'UTC'")


def display_date(ts) -> Column:
    """'dd MMM yyyy' (D9)."""
    return F.date_format(_c(ts), "dd MMM yyyy")
