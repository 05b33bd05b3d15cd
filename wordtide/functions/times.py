"""Times. `ts` is a TIMESTAMP_NTZ wall clock, so no result depends on the session zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wordtide.functions import patterns as P


def epoch_second(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 of the wall clock, fractions cut off."""
    return F.unix_timestamp(ts)


def ntz_from_epoch(second: Column) -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), second
    )


def parse_created_at(created_at: Column, zone: str = "UTC") -> Column:
    """`Sat Feb 01 06:00:05 +0000 2020` as the wall clock of `zone`."""
    instant = F.try_to_timestamp(F.substr(created_at, F.lit(5)), F.lit(P.CREATED_AT))
    return F.convert_timezone(
        F.lit("UTC"), F.lit(zone), ntz_from_epoch(F.unix_timestamp(instant))
    )


def format_created_at(ts: Column) -> Column:
    """The inverse of `parse_created_at` for UTC wall clocks."""
    return F.date_format(ts, "EEE MMM dd HH:mm:ss '+0000' yyyy")


def strictly_between(ts: Column, low: str, high: str) -> Column:
    """Both ends excluded, at whole seconds; `low` and `high` are whole seconds.

    Compares the raw column, so the source can skip files and row groups.
    """
    first = F.expr(f"timestamp_ntz'{low}' + INTERVAL 1 SECOND")
    return (ts >= first) & (ts < F.expr(f"timestamp_ntz'{high}'"))


def second_of_day(ts: Column) -> Column:
    return F.pmod(epoch_second(ts), F.lit(P.DAY_SECONDS))


def quarter_of_day(ts: Column) -> Column:
    return F.floor(second_of_day(ts) / P.QUARTER_SECONDS).cast("int")


def inside_quarter(ts: Column) -> Column:
    """False for the five seconds of a day that the exclusive bounds lose."""
    second = second_of_day(ts)
    return (second % P.QUARTER_SECONDS != 0) & (second != P.LAST_SECOND)
