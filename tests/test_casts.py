import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespoon.functions import business_date, hash_pii, hour_bucket, to_float, to_int, to_local_ts, to_string, utc_ts

INF = float("inf")


def values(spark, texts, column, kind="string"):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, f"i int, x {kind}").repartition(3)
    return [r[1] for r in sorted(df.select("i", column("x")).collect())]


NUMBERS = {
    "1.7": (1.7, 1), "-1.7": (-1.7, -1), " 3 ": (3.0, 3), "\t4\n": (4.0, 4), "1e3": (1000.0, 1000), "+5": (5.0, 5),
    "1.": (1.0, 1), ".5": (0.5, 0), "nan": (0.0, 0), "inf": (INF, 0), "-Infinity": (-INF, 0), "abc": (0.0, 0),
    "1,000": (0.0, 0), "1_000": (0.0, 0), "0x10": (0.0, 0), "1d": (0.0, 0), "1e": (0.0, 0), "": (0.0, 0),
    "1 2": (0.0, 0), "1e400": (0.0, 0), "9007199254740993": (9007199254740992.0, 9007199254740993),
    "1e300": (1e300, 0), "99999999999999999999": (1e20, 0), "9223372036854775808": (2.0**63, 0), "-9223372036854775809": (-(2.0**63), 0),
    "9223372036854774784": (9223372036854774784.0, 9223372036854774784), None: (0.0, 0),
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers_out_of_text(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert values(spark, NUMBERS, to_float) == [f for f, _ in NUMBERS.values()]
        assert values(spark, NUMBERS, to_int) == [i for _, i in NUMBERS.values()]
        assert values(spark, DATES, utc_ts) == list(DATES.values())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_numbers_out_of_numbers(spark):
    doubles = [1.7, -1.7, float("nan"), INF, None]
    as_float = lambda c: to_float(c, T.DoubleType())
    assert values(spark, doubles, as_float, "double") == [1.7, -1.7, 0.0, INF, 0.0]
    as_int = lambda c: to_int(c, T.DoubleType())
    assert values(spark, doubles, as_int, "double") == [1, -1, 0, 0, 0]
    from_long = lambda c: to_int(c, T.LongType())
    assert values(spark, [2**53 + 1, None], from_long, "bigint") == [2**53 + 1, 0]


def test_text(spark):
    assert values(spark, [1, None], to_string, "bigint") == ["1", None]
    assert values(spark, [True, None], to_string, "boolean") == ["true", None]


def at(*parts):
    return dt.datetime(*parts)


# What a date text means in UTC.
DATES = {
    "2024-01-20T08:00:00+07:00": at(2024, 1, 20, 1), "2024-01-20T20:00:00Z": at(2024, 1, 20, 20),
    "2024-01-20 20:00": at(2024, 1, 20, 20), "2024-01-20T20": at(2024, 1, 20, 20), "2024-01-20": at(2024, 1, 20),
    "20240120": at(2024, 1, 20), "2024": at(2024, 1, 1), "2024-01": at(2024, 1, 1), "2024-1-5": at(2024, 1, 5),
    "2024/01/20": at(2024, 1, 20), "20240120T2000": at(2024, 1, 20, 20), "20240120T200000Z": at(2024, 1, 20, 20),
    "2024-01-20T20:00:00.123456789+0700": at(2024, 1, 20, 13, 0, 0, 123456),
    "2024-01-20T20:00:00-00:30": at(2024, 1, 20, 20, 30), "2024-01-20T20:00:00+07": at(2024, 1, 20, 13),
    "2024-01-20T20:00:00 +07:00": at(2024, 1, 20, 13), "2024-01-20T20:00:00Z ": at(2024, 1, 20, 20),
    "20240120T200000+07 \t": at(2024, 1, 20, 13), " 2024-01-20": at(2024, 1, 20),
    "2024-01-20T20:00:00.5": at(2024, 1, 20, 20, 0, 0, 500000),
    "T08:00": None, "20/01/2024": None, "": None, None: None, "99999-01-01": None, "1600-01-01": None,
    "2300-01-01": None, "0001-01-01T00:00:00": None, "2024-02-30": None, "2024-01-20T24:00:00": None,
    "2024-01-20T23:59:60": None, "2024-01-20 ": None, "2024-01-20T": None, "202401": None, "yesterday": None,
    "2024-01-20T20:00:00+25:00": None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Ho_Chi_Minh"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert values(spark, DATES, utc_ts) == list(DATES.values())
        local = [t and t + dt.timedelta(hours=7) for t in DATES.values()]
        assert values(spark, DATES, to_local_ts) == local
        assert values(spark, DATES, business_date) == [t and t.strftime("%Y-%m-%d") for t in local]
        naive = [at(2024, 3, 10, 2, 30), at(2024, 1, 20, 20), None]  # the first is skipped by a clock change
        moved = lambda c: to_local_ts(c, T.TimestampNTZType())
        assert values(spark, naive, moved, "timestamp_ntz") == [at(2024, 3, 10, 9, 30), at(2024, 1, 21, 3), None]
        assert values(spark, naive, lambda c: hour_bucket(F.col(c)), "timestamp_ntz") == ["02", "20", None]
        instant = spark.sql("SELECT TIMESTAMP'2024-01-20 20:00:00Z' AS x")
        assert instant.select(to_local_ts("x", T.TimestampType())).first()[0] == at(2024, 1, 21, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_historic_offset(spark):
    # Saigon was an hour further ahead in the sixties.
    assert values(spark, ["1965-01-01T00:00:00Z"], to_local_ts) == [at(1965, 1, 1, 8)]


def test_hash(spark):
    # Upper-case hex of the MD5 of the UTF-8 bytes.
    assert values(spark, ["", None, "Nguyễn"], lambda c: hash_pii(F.col(c))) == [
        "D41D8CD98F00B204E9800998ECF8427E",
        None,
        __import__("hashlib").md5("Nguyễn".encode()).hexdigest().upper(),
    ]


def test_dates_at_the_ends_of_the_range(spark):
    ends = {
        "1677-09-21": None, "1677-09-22": at(1677, 9, 22), "1678": at(1678, 1, 1), "2261-12-31T23:59:59Z": at(2261, 12, 31, 23, 59, 59),
        "2262-04-11": at(2262, 4, 11), "2262-04-12": None, "2262": at(2262, 1, 1),
    }
    assert values(spark, ends, utc_ts) == list(ends.values())


def test_a_date_is_matched_step_by_step_once(spark):
    """Its text was matched anew wherever the result was used: three times over for each of an invoice's dates."""
    dates = spark.range(3).select(F.col("id").cast("string").alias("x")).select(to_local_ts("x").alias("t"))
    assert dates._jdf.queryExecution().optimizedPlan().toString().count("RLIKE(") == 3
