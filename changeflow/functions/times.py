"""The two time formats found in change files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names of the older text format.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# "Mar 7, 2001 3:7:9": a 12-hour clock without AM or PM, so afternoon times cannot be told apart.
OLD_FORMAT = r"^([A-Z][a-z]{2}) (\d{1,2}), (\d{4}) (\d{1,2}):(\d{1,2}):(\d{1,2})$"


def read_time(text: Column) -> Column:
    """ISO text or the older format to TIMESTAMP_NTZ; anything else is null."""

    def part(n: int, width: int = 2) -> Column:
        return F.lpad(F.regexp_extract(text, OLD_FORMAT, n), width, "0")

    names = F.array(*[F.lit(m) for m in MONTHS])
    month = F.array_position(names, F.regexp_extract(text, OLD_FORMAT, 1)).cast("string")
    old = F.concat(
        part(3, 4), F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), part(2),
        F.lit(" "), part(4), F.lit(":"), part(5), F.lit(":"), part(6),
    )
    return F.coalesce(text.try_cast("timestamp_ntz"), F.when(text.rlike(OLD_FORMAT), old.try_cast("timestamp_ntz")))


def moment(when: datetime) -> Column:
    """A TIMESTAMP_NTZ literal, the same in every session time zone."""
    return F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")


def write_time(moment: Column) -> Column:
    """ISO text, which keeps the afternoon."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
