"""Calendar and clock features of a timestamp.

Each part is one SQL expression over built-ins. The same text serves the
DataFrame form (``date_parts``) and the pipeline stage (``date_stage``), so
both give the same numbers. NULL in, NULL out; every part is ``int``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Output suffixes of the date features, in output order.
CLOCK_PARTS = ("year", "month", "day", "hour", "minute")
CALENDAR_PARTS = (
    "year",
    "quarter",
    "month",
    "weekNumber",
    "weekDay",
    "yearDay",
    "hour",
    "minute",
    "minuteFromDayBeginning",
)
PART_SETS = {"clock": CLOCK_PARTS, "calendar": CALENDAR_PARTS}

# SQL of each part; {c} is a quoted date or timestamp column.
_PART_SQL = {
    "year": "year({c})",
    "month": "month({c})",
    "day": "dayofmonth({c})",
    "hour": "hour({c})",
    "minute": "minute({c})",
    "weekDay": "weekday({c}) + 1",
    "yearDay": "dayofyear({c})",
    "minuteFromDayBeginning": "hour({c}) * 60 + minute({c})",
}
# "month_div_4" is floor(month / 4) + 1: Jan-Mar 1, Apr-Jul 2, Aug-Nov 3, Dec 4.
_QUARTER_SQL = {
    "month_div_4": "CAST(month({c}) DIV 4 + 1 AS INT)",
    "calendar": "quarter({c})",
}
# ISO weeks start on Monday and need four days in the year. US weeks start on
# Sunday and need one day, so week number = week of the Saturday that ends it.
_WEEK_SQL = {
    "iso": "weekofyear({c})",
    "us": "CAST(ceil(dayofyear(date_add(CAST({c} AS DATE), 7 - dayofweek({c}))) / 7) AS INT)",
}

QUARTERS = tuple(_QUARTER_SQL)
WEEK_SYSTEMS = tuple(_WEEK_SQL)


def quote(name: str) -> str:
    """Column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def part_sql(column: str, part: str, week_system: str = "iso", quarter: str = "month_div_4") -> str:
    """SQL text of one date part of ``column``."""
    if part == "quarter":
        template = _QUARTER_SQL[quarter]
    elif part == "weekNumber":
        template = _WEEK_SQL[week_system]
    else:
        template = _PART_SQL[part]
    return template.format(c=quote(column))


def date_part(column: str, part: str, week_system: str = "iso", quarter: str = "month_div_4") -> Column:
    """One date part of ``column`` as an ``int`` column."""
    return F.expr(part_sql(column, part, week_system, quarter))


def part_columns(column: str, parts: Sequence[str]) -> list[str]:
    """Names of the columns the parts of ``column`` are stored in, in order."""
    return [f"{column}_{part}" for part in parts]


def date_parts(
    df: DataFrame,
    column: str,
    parts: Sequence[str] = CALENDAR_PARTS,
    week_system: str = "iso",
    quarter: str = "month_div_4",
) -> DataFrame:
    """``df`` plus ``<column>_<part>`` for every part, in one projection."""
    return df.withColumns(
        {
            name: date_part(column, part, week_system, quarter)
            for name, part in zip(part_columns(column, parts), parts)
        }
    )


def enrich_dates(
    df: DataFrame,
    column: str,
    week_system: str = "iso",
    quarter: str = "month_div_4",
) -> DataFrame:
    """``df`` plus ``<column>_timestamp`` and the nine calendar parts of it.

    A timestamp of either kind stays as it is; strings and dates have no time
    zone, and become timestamps without one.
    """
    stamp = f"{column}_timestamp"
    source = F.col(quote(column))
    if not isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType)):
        source = source.cast("timestamp_ntz")
    stamped = df.withColumn(stamp, source)
    return stamped.withColumns(
        {
            name: date_part(stamp, part, week_system, quarter)
            for name, part in zip(part_columns(column, CALENDAR_PARTS), CALENDAR_PARTS)
        }
    )


def zone_clock(column: str, zone: str | Column) -> Column:
    """What a clock in ``zone`` shows at the instant of a timestamp, as a timestamp without zone.

    ``zone`` is a name or a column of names. The session's time zone does not matter.
    Every instant has one clock time. When clocks are set back, an hour is shown
    twice, and ``repeated_hour`` says which; the hour that is left out when they
    are set forward is never shown. NULL for a NULL instant or zone.
    """
    name = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(F.lit("UTC"), name, _utc_clock(column))


def _utc_clock(column: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({quote(column)}), TIMESTAMP_NTZ '1970-01-01 00:00:00')")


def zone_instant(clock: Column, zone: str | Column) -> Column:
    """The instant, as UTC clock time without zone, at which a clock in ``zone`` shows ``clock``.

    Of an hour that occurs twice it is the first. A time in the hour that does not
    occur is that much after the last one that does, so 2:30 is read as 3:30.
    """
    name = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(name, F.lit("UTC"), clock)


def repeated_hour(column: str, zone: str | Column) -> Column:
    """1 if the clock in ``zone`` showed the time of this instant before, as after clocks are set back, else 0."""
    return (zone_instant(zone_clock(column, zone), zone) != _utc_clock(column)).cast("int")


def zoned_date_parts(
    df: DataFrame,
    column: str,
    zone: str | Column,
    parts: Sequence[str] = CALENDAR_PARTS,
    week_system: str = "iso",
    quarter: str = "month_div_4",
) -> DataFrame:
    """``df`` plus ``<column>_local``, the clock time in ``zone``, its parts and ``<column>_repeated``.

    ``column`` is a timestamp of an instant. The hour that occurs twice has the same
    parts both times and ``<column>_repeated`` 1 the second time.
    """
    if not isinstance(df.schema[column].dataType, T.TimestampType):
        raise ValueError(f"{column} is no instant; its clock time has no zone to be moved from")
    local = f"{column}_local"
    stamped = df.withColumns({local: zone_clock(column, zone), f"{column}_repeated": repeated_hour(column, zone)})
    named = zip(part_columns(column, parts), parts, strict=True)
    return stamped.withColumns({name: date_part(local, part, week_system, quarter) for name, part in named})


def date_stage(
    columns: Sequence[str],
    parts: Sequence[str] = CLOCK_PARTS,
    week_system: str = "iso",
    quarter: str = "month_div_4",
    missing: int | None = None,
) -> SQLTransformer:
    """Pipeline stage that adds the parts of every column; it saves with the model.

    The parts of a NULL are NULL, or ``missing`` if that is given.
    """

    def whole(text: str) -> str:
        return text if missing is None else f"coalesce({text}, {missing})"

    added = [
        f"{whole(part_sql(column, part, week_system, quarter))} AS {quote(name)}"
        for column in columns
        for name, part in zip(part_columns(column, parts), parts)
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(added)} FROM __THIS__")
