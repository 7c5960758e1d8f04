"""Numbers and null defaults."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zero_if_null(name: str) -> Column:
    """A missing amount counts as zero."""
    return F.coalesce(F.col(name), F.lit(0.0))


def round_half_up(x: Column) -> Column:
    """Two places, halves towards plus infinity; Spark's own round moves negative halves away from zero."""
    return F.floor(x * 100.0 + 0.5) / F.lit(100.0)


def months_between_calendars(start: Column, end: Column) -> Column:
    """Calendar months from start to end, the day of month ignored."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def default_fill(df: DataFrame, texts: list[str] = (), numbers: list[str] = ()) -> DataFrame:
    """Null text becomes '', null numbers become 0, in the named columns only."""
    return df.withColumns(
        {n: F.coalesce(F.col(n), F.lit("")) for n in texts}
        | {n: F.coalesce(F.col(n), F.lit(0).cast(df.schema[n].dataType)) for n in numbers}
    )
