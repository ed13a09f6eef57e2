import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from touchline.functions import casting, similarity, text
from touchline.functions.status import fetch_status
from touchline.operators.project import round_to_millis


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "day, season",
    [("2024-06-30", "2023/24"), ("2024-07-01", "2024/25"), ("1999-08-01", "1999/00"), ("2000-01-01", "1999/00")],
)
def test_season_label(spark, day, season):
    assert one(spark, text.season_label(F.col("d").cast("date")), d=day) == season


def test_full_name_with_a_missing_part_is_missing(spark):
    assert one(spark, text.full_name(F.col("a"), F.col("b")), a="Bukayo", b="Saka") == "Bukayo Saka"
    assert one(spark, text.full_name(F.col("a"), F.lit(None).cast("string")), a="Bukayo") is None


def test_date_text(spark):
    assert one(spark, text.iso_date(F.col("s")), s="Aug 17 2024") == "2024-08-17"
    assert one(spark, text.iso_date(F.col("s")), s="aug 07 2024") == "2024-08-07"
    assert one(spark, text.iso_date(F.col("s"), strict=False), s="2024-08-17") is None
    with pytest.raises(PySparkException):
        one(spark, text.iso_date(F.col("s")), s="2024-08-17")


@pytest.mark.parametrize(
    "raw, decoded",
    [
        (r"\x7B\x22league\x22:\x22EPL\x22\x7D", '{"league":"EPL"}'),
        (r"caf\xE9 é", "café é"),
        (r"a\\x41", r"a\x41"),
        ('say "hi"', 'say "hi"'),
        (r"tab\tend!", "tab\tend!"),
        (r"it\'s", "it's"),
        ("", ""),
    ],
)
def test_decode_escapes(spark, raw, decoded):
    assert one(spark, text.decode_escapes(F.col("s")), s=raw) == decoded


def test_match_info_text(spark):
    page = r"<script>var   match_info = JSON.parse('\x7B\x22league\x22\x3A\x22EPL\x22,\x22league_id\x22:1\x7D');</script>"
    got = one(spark, text.match_info(text.match_info_text(F.col("h"))), h=page)
    assert (got.league, got.league_id, got.team_h) == ("EPL", "1", None)
    for bad in ("<html>no data</html>", "var match_info = JSON.parse('{}');", "var match_info = JSON.parse('not json');"):
        assert one(spark, text.match_info(text.match_info_text(F.col("h"))), h=bad) is None


@pytest.mark.parametrize(
    "name, norm",
    [("Ødegaard-M.", "degaard m"), ("Šeško", "šeško"), ("  A_b C ", "a_b c"), ("..", ""), ("O'Neil", "o neil")],
)
def test_normalise_name(spark, name, norm):
    assert one(spark, text.normalise_name(F.col("s")), s=name) == norm


@pytest.mark.parametrize(
    "page, league, league_id, api, body, status",
    [
        (None, "EPL", "1", 200, "{}", "understat_request_error"),
        (404, "EPL", "1", 200, "{}", "understat_404_error"),
        (200, None, None, 200, "{}", "missing_match_data"),
        (200, "X", "2", 200, "{}", "not_epl"),
        (200, "X", "1", 200, "{}", "ok"),
        (200, "EPL", "9", None, "{}", "api_request_error"),
        (200, "EPL", "9", 404, "{}", "api_404_error"),
        (200, "EPL", "9", 200, "<html>", "api_decode_error"),
        (200, "EPL", "9", 200, "{}", "ok"),
        (500, "EPL", "9", 500, "{}", "ok"),
    ],
)
def test_status(spark, page, league, league_id, api, body, status):
    lit = lambda v, ty: F.lit(v).cast(ty)
    info = F.struct(lit(league, "string").alias("league"), lit(league_id, "string").alias("league_id"))
    info = F.when(F.lit(league is not None), info)
    got = fetch_status(lit(page, "int"), info, lit(api, "int"), lit(body, "string"))
    assert spark.range(1).select(got.alias("v")).first().v == status


def test_strict_cast(spark):
    assert one(spark, casting.strict(F.col("s"), "int"), s="90") == 90
    with pytest.raises(PySparkException):
        one(spark, casting.strict(F.col("s"), "int"), s="1.5")
    with pytest.raises(PySparkException):
        one(spark, casting.strict(F.lit(None).cast("string"), "int"))


def test_lenient_cast(spark):
    df = spark.createDataFrame([("90",), ("1.5",), (None,)], "s string")
    good, bad = casting.lenient(df, {"s": "int"})
    assert [r.s for r in good.collect()] == [90]
    assert sorted([r.s for r in bad.collect()], key=str) == ["1.5", None]


def test_timestamps_ignore_the_zone_and_round_to_millis(spark):
    assert one(spark, casting.naive_timestamp(F.col("s")), s="2024-08-16T19:00:00Z") == dt.datetime(2024, 8, 16, 19)
    rounded = one(spark, round_to_millis(F.col("s")), s="2024-08-16 19:00:00.0006")
    assert rounded == dt.datetime(2024, 8, 16, 19, 0, 0, 1000)


@pytest.mark.parametrize(
    "a, b, score",
    [
        ("red widget", "red widget", 100.0),
        ("widget red", "red widget", 95.0),  # tokens in another order
        ("red widget", "red widget co", 95.0),  # all tokens of one in the other
        ("salah", "mohamed salah", 90.0),  # a window of the longer name
        ("salah m", "mohamed salah hamed", 85.5),  # one shared token
        ("", "red", 0.0),
    ],
)
def test_combined_score(spark, a, b, score):
    assert one(spark, similarity.combined(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(score)


def test_rounding_goes_to_even(spark):
    assert one(spark, similarity.rounded(F.col("x")), x=79.5) == 80
    assert one(spark, similarity.rounded(F.col("x")), x=80.5) == 80
