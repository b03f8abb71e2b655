"""Time parts of observation and ingestion times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solvind.schemas import EARLIEST, LATEST

SECONDS_PER_HOUR = 3_600
SECONDS_PER_DAY = 86_400


def epoch_to_timestamp(epoch: Column, tz: str = "UTC") -> Column:
    """Session zone must be UTC; another `tz` shifts to that site's wall clock."""
    stamp = F.timestamp_seconds(epoch)
    return stamp if tz == "UTC" else F.from_utc_timestamp(stamp, tz)


def local_seconds(epoch: Column, tz: str = "UTC") -> Column:
    """Epoch seconds moved to the wall clock of `tz`."""
    return epoch if tz == "UTC" else F.unix_seconds(epoch_to_timestamp(epoch, tz))


def hour_start(epoch: Column, tz: str = "UTC") -> Column:
    """First second of the hour. One integer stands for year, month, day and hour as a grouping key."""
    seconds = local_seconds(epoch, tz)
    return seconds - F.pmod(seconds, F.lit(SECONDS_PER_HOUR))


def hour_of_day(hour_start: Column) -> Column:
    return F.floor(F.pmod(hour_start, F.lit(SECONDS_PER_DAY)) / SECONDS_PER_HOUR).cast("int")


def observed_day(epoch: Column, tz: str = "UTC") -> Column:
    return epoch_to_timestamp(epoch, tz).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def add_time_parts(df: DataFrame, epoch: str = "dt", tz: str = "UTC") -> DataFrame:
    """Add timestamp, year, month, day, hour and the `yyyy-MM-dd` date string.

    Columns the table already stores as its layout (year, month) are kept, so filters on them still prune.
    """
    stamp = epoch_to_timestamp(F.col(epoch), tz)
    parts = {
        "timestamp": stamp,
        "year": F.year(stamp),
        "month": F.month(stamp),
        "day": F.dayofmonth(stamp),
        "hour": F.hour(stamp),
        "date": F.date_format(stamp, "yyyy-MM-dd"),
    }
    stored = df.columns if tz == "UTC" else ()
    return df.withColumns({name: part for name, part in parts.items() if name not in stored})


def add_ingestion_partitions(df: DataFrame, ts_col: str = "ingestion_timestamp") -> DataFrame:
    """Arrival-day partition columns: late events land in the day they arrive, by design."""
    day = F.col(ts_col).cast("date")
    return df.withColumns(
        {"ingestion_date": day, "year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}
    )


def is_plausible(dt: Column) -> Column:
    """The epoch second is one that an observation can have; false for NULL. Milliseconds, for one, are not."""
    return F.coalesce(dt.between(EARLIEST, LATEST), F.lit(False))
