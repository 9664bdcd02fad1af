from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ledgerloom.functions.dates import (
    CALENDAR_PARTS,
    CLOCK_PARTS,
    date_part,
    date_parts,
    date_stage,
    enrich_dates,
    part_columns,
    repeated_hour,
    zone_clock,
    zone_instant,
    zoned_date_parts,
)


def _us_week(day: date) -> int:
    """Weeks start on Sunday; week 1 is the one that holds 1 January."""

    def first_sunday(year):
        january = date(year, 1, 1)
        return january - timedelta(days=(january.weekday() + 1) % 7)

    start = max(s for s in (first_sunday(day.year), first_sunday(day.year + 1)) if s <= day)
    return (day - start).days // 7 + 1


def test_week_numbers_on_every_day_around_new_year(spark):
    days = [
        date(year, 12, 24) + timedelta(days=i) for year in range(1990, 2031) for i in range(18)
    ]
    df = spark.createDataFrame([(day,) for day in days], "d date").repartition(4)
    rows = df.select("d", date_part("d", "weekNumber", "iso"), date_part("d", "weekNumber", "us")).collect()
    assert len(rows) == len(days)
    for day, iso, us in rows:
        assert iso == day.isocalendar()[1]
        assert us == _us_week(day)


def test_quarter_forms_for_every_month(spark):
    df = spark.createDataFrame([(date(2023, m, 15),) for m in range(1, 13)], "d date").coalesce(1)
    legacy, calendar = zip(
        *df.select(date_part("d", "quarter"), date_part("d", "quarter", quarter="calendar")).collect()
    )
    assert legacy == (1, 1, 1, 2, 2, 2, 2, 3, 3, 3, 3, 4)
    assert calendar == (1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4)


def _expected(stamp: datetime) -> tuple:
    return (
        stamp.year,
        stamp.month // 4 + 1,
        stamp.month,
        stamp.isocalendar()[1],
        stamp.isoweekday(),
        stamp.timetuple().tm_yday,
        stamp.hour,
        stamp.minute,
        stamp.hour * 60 + stamp.minute,
    )


@pytest.mark.parametrize("sql_type", ["timestamp", "timestamp_ntz"])
def test_all_parts(spark, sql_type):
    stamps = [datetime(2020, 1, 1) + timedelta(hours=31 * i, minutes=7 * i) for i in range(300)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], f"id int, t {sql_type}")
    out = date_parts(df, "t").orderBy("id")
    assert out.columns == ["id", "t", *part_columns("t", CALENDAR_PARTS)]
    assert all(t == "int" for _, t in out.dtypes[2:])
    assert [tuple(row[2:]) for row in out.collect()] == [_expected(s) for s in stamps]


def test_null_in_null_out(spark):
    df = spark.createDataFrame([(None,)], "t timestamp")
    assert set(date_parts(df, "t", (*CLOCK_PARTS, *CALENDAR_PARTS)).drop("t").first()) == {None}


def test_enrich_keeps_the_timestamp_of_a_text_column(spark):
    df = spark.createDataFrame([("2024-03-10 13:45:00",)], "`when ` string")
    out = enrich_dates(df, "when ")
    assert out.columns == ["when ", "when _timestamp", *part_columns("when ", CALENDAR_PARTS)]
    assert out.schema["when _timestamp"].dataType.simpleString() == "timestamp_ntz"
    assert tuple(out.first()[2:]) == _expected(datetime(2024, 3, 10, 13, 45))


def test_output_columns_are_nine_distinct_names():
    assert len(set(part_columns("t", CALENDAR_PARTS))) == 9


@pytest.mark.parametrize("week_system", ["iso", "us"])
def test_stage_equals_projection_and_survives_saving(spark, tmp_path, week_system):
    df = spark.createDataFrame(
        [(datetime(2022, 12, 31, 5, 6), datetime(2021, 1, 3, 7, 8))], "`a``b` timestamp_ntz, c timestamp"
    )
    stage = date_stage(["a`b", "c"], CALENDAR_PARTS, week_system)
    projected = date_parts(date_parts(df, "a`b", week_system=week_system), "c", week_system=week_system)
    assert stage.transform(df).first() == projected.first()
    PipelineModel([stage]).write().save(str(tmp_path / "m"))
    assert PipelineModel.load(str(tmp_path / "m")).transform(df).first() == projected.first()


def test_times_without_a_zone_are_not_shifted_by_summer_time(spark):
    """02:30 does not exist in Berlin on that day, but in a column without a zone it does."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-31 02:30:00' AS ts, '2024-03-31 02:30:00' AS t, date'2024-03-31' AS d")
        for column, minute in (("ts", 150), ("t", 150), ("d", 0)):
            row = enrich_dates(df, column).first()
            assert row[f"{column}_minuteFromDayBeginning"] == minute
            assert row[f"{column}_hour"] == minute // 60
        assert dict(enrich_dates(df, "ts").dtypes)["ts_timestamp"] == "timestamp_ntz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


ZONES = ["America/New_York", "Europe/Berlin", "Asia/Kolkata", "Australia/Lord_Howe", "UTC"]


@pytest.fixture(params=["UTC", "America/Los_Angeles"])
def session_zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def _instants(spark, step=20 * 60):
    """Every 20 minutes around the changes of clocks of two years, by zone."""
    seconds = [at for start in (1711800000, 1709900000, 1730500000, 1729900000, 1743200000) for at in range(start, start + 400_000, step)]
    rows = [(second, zone) for second in seconds for zone in ZONES]
    return spark.createDataFrame(rows, "s bigint, zone string").withColumn("at", F.timestamp_seconds("s"))


def test_clock_of_a_zone_by_row_whatever_the_session_zone(session_zone):
    df = zoned_date_parts(_instants(session_zone), "at", F.col("zone"))
    for row in df.withColumn("local", F.col("at_local").cast("string")).drop("at", "at_local").collect():
        own = datetime.fromtimestamp(row.s, timezone.utc).astimezone(ZoneInfo(row.zone))
        assert row.local == own.strftime("%Y-%m-%d %H:%M:%S")
        assert (row.at_year, row.at_month, row.at_hour, row.at_minute) == (own.year, own.month, own.hour, own.minute)
        assert row.at_weekDay == own.isoweekday()
        assert row.at_repeated == own.fold


def test_instants_of_the_hours_that_occur_twice_or_not_at_all(spark):
    clocks = ["2024-03-10 01:59:59", "2024-03-10 02:30:00", "2024-03-10 03:00:00", "2024-11-03 01:30:00", "2024-11-03 02:00:00"]
    df = spark.createDataFrame([(text,) for text in clocks], "text string")
    instant = zone_instant(F.col("text").cast("timestamp_ntz"), "America/New_York").cast("string").alias("utc")
    assert [row.utc for row in df.select(instant).collect()] == [
        "2024-03-10 06:59:59", "2024-03-10 07:30:00", "2024-03-10 07:00:00", "2024-11-03 05:30:00", "2024-11-03 07:00:00",
    ]


def test_null_instants_and_zones_have_no_clock(spark):
    df = spark.createDataFrame([(None, "UTC"), (5, None)], "s bigint, zone string").withColumn("at", F.timestamp_seconds("s"))
    columns = [zone_clock("at", F.col("zone")).alias("clock"), repeated_hour("at", F.col("zone")).alias("again")]
    assert [tuple(row) for row in df.select(*columns).collect()] == [(None, None), (None, None)]
    with pytest.raises(ValueError, match="no instant"):
        zoned_date_parts(df.select(F.col("at").cast("timestamp_ntz").alias("at")), "at", "UTC")
