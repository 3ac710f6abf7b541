"""Calendar dimension: one row per day of an inclusive range, or of the years which data touch.

The days that occur in date columns are kept as bitmaps, a bit for each day of some ninety years,
which tasks build on their own and an aggregation merges. However many rows there are, what is left are some rows of
four kilobytes each. They say which years a calendar must span, which dates lie so far off that they are
rather errors, and whether a calendar covers every date, without a join.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.fixed_values import CALENDAR_END, CALENDAR_START
from orestrata.functions.keys import date_key

#: Years within which dates stretch the calendar of a build.
PLAUSIBLE_YEARS = (1900, 2100)
#: The number of the epoch if the first day of year 1 is number 1; bitmaps count from 1.
_EPOCH = 719_163
_BUCKET, _BITMAP = "bucket", "bitmap"
_BUCKET_BITS = 32_768


def day_bitmaps(df: DataFrame, columns: Iterable[str], together: str | None = None) -> DataFrame:
    """(Column, bucket, bitmap): the different days each column holds, or all of them under one name.

    Dates before year 1 are not told apart.
    """
    dates = F.explode(
        F.array(*[F.struct(F.lit(together or c).alias("Column"), F.col(c).alias("Date")) for c in columns])
    )
    days = df.select(dates.alias("each")).where("each.Date IS NOT NULL").select("each.*")
    number = F.greatest(F.unix_date("Date") + _EPOCH, F.lit(1)).cast("bigint")
    return (
        days.select("Column", F.bitmap_bucket_number(number).alias(_BUCKET), F.bitmap_bit_position(number).alias("bit"))
        .groupBy("Column", _BUCKET)
        .agg(F.bitmap_construct_agg("bit").alias(_BITMAP))
    )


def days_of(bitmaps: DataFrame) -> DataFrame:
    """(Column, Date): the days the bitmaps hold."""
    whole = F.hex(_BITMAP)
    octets = bitmaps.select(
        "Column", _BUCKET, F.posexplode(F.sequence(F.lit(0), F.lit(_BUCKET_BITS // 8 - 1))).alias("octet", "_"), whole.alias("hex")
    ).select("Column", _BUCKET, "octet", F.conv(F.expr("substr(hex, 2 * octet + 1, 2)"), 16, 10).cast("int").alias("bits"))
    bits = octets.where("bits > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
    # buckets count from 1, the bits of an octet from its lowest
    number = (F.col(_BUCKET) - 1) * _BUCKET_BITS + F.col("octet") * 8 + F.col("bit") + 1 - _EPOCH
    held = bits.where(F.expr("(shiftright(bits, bit) & 1) = 1"))
    return held.select("Column", F.date_from_unix_date(number.cast("int")).alias("Date"))


def _days(bounds: DataFrame) -> DataFrame:
    """Attributes of each day between the columns ``first`` and ``last`` of each row, in order."""
    day = F.col("Date")
    return bounds.select(F.explode(F.sequence("first", "last")).alias("Date")).select(
        date_key(day).alias("DateKey"),
        day,
        F.year(day).alias("Year"),
        F.quarter(day).alias("Quarter"),
        F.month(day).alias("Month"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.day(day).alias("Day"),
        F.dayofweek(day).alias("DayOfWeek"),
        F.date_format(day, "EEEE").alias("DayName"),
    )


def dim_date(
    spark: SparkSession, start: str | date = CALENDAR_START, end: str | date = CALENDAR_END
) -> DataFrame:
    """The calendar of a given range. Weeks begin on Sunday (day 1)."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last")
    )
    return _days(bounds)


def _plausible(day, earliest: int, latest: int):
    return F.year(day).between(earliest, latest)


def dim_date_spanning(
    df: DataFrame, columns: Iterable[str], earliest: int = 1, latest: int = 9999
) -> DataFrame:
    """The calendar of all whole years from the first to the last which the given date columns touch.

    Days outside the years ``earliest`` to ``latest`` do not stretch it; those that occur are rows of their own, so
    that every date is found. Years are dealt to tasks one by one.
    """
    days = days_of(day_bitmaps(df, columns, together="all")).select("Date")
    near = _plausible("Date", earliest, latest)
    years = days.where(near).agg(F.min(F.year("Date")).alias("low"), F.max(F.year("Date")).alias("high"))
    whole = years.where("low IS NOT NULL").select(F.explode(F.sequence("low", "high")).alias("year")).select(
        F.make_date("year", F.lit(1), F.lit(1)).alias("first"), F.make_date("year", F.lit(12), F.lit(31)).alias("last")
    )
    if (earliest, latest) != (1, 9999):
        whole = whole.unionByName(days.where(~near).select(F.col("Date").alias("first"), F.col("Date").alias("last")))
    return _days(whole)


def calendar_coverage(
    df: DataFrame, columns: Iterable[str], calendar: DataFrame, earliest: int = 1, latest: int = 9999
) -> DataFrame:
    """(Column, Days, DaysMissing, Outliers, FirstOutlier, LastOutlier) of each date column.

    How many different days it holds, how many of them the calendar lacks, and how many lie outside the given
    years. Compared are bitmaps of days, not rows.
    """
    held = days_of(day_bitmaps(df, columns))
    known = days_of(day_bitmaps(calendar.select("Date"), ["Date"])).select("Date", F.lit(True).alias("known"))
    odd = ~_plausible("Date", earliest, latest)
    found = held.join(known, "Date", "left").groupBy("Column").agg(
        F.count(F.lit(1)).alias("Days"),
        F.count_if(F.col("known").isNull()).alias("DaysMissing"),
        F.count_if(odd).alias("Outliers"),
        F.min(F.when(odd, F.col("Date"))).alias("FirstOutlier"),
        F.max(F.when(odd, F.col("Date"))).alias("LastOutlier"),
    )
    asked = df.sparkSession.createDataFrame([(column,) for column in columns], "Column string")
    return asked.join(found, "Column", "left").fillna(0, ["Days", "DaysMissing", "Outliers"])
