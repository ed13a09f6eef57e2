import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchline.operators import dedupe, filters, joins, keys, marks, project, quality, sets
from touchline.schemas import HISTORY_MAPPING, TABLES
from touchline.sources.tables import empty, from_records, param_union


def test_range_and_chunks(spark):
    for mark, low, high in ((1000, 950, 1150), (0, -50, 150)):
        frame = spark.createDataFrame([(mark,)], "mark long")
        ids = marks.candidate_ids(frame)
        assert ids.agg(F.min("id"), F.max("id"), F.count("id")).first() == (low, high, 201)
        sizes = ids.groupBy(marks.batch_id(F.col("id"), F.lit(low)).alias("b")).count().orderBy("b").collect()
        assert [r["count"] for r in sizes] == [25] * 8 + [1]


def test_marks(spark):
    a = spark.createDataFrame([(7,), (9,)], "i int")
    b = spark.createDataFrame([(9,), (4,)], "j int")
    assert marks.union_max([(a, "i"), (b, "j")]).first().mark == 9
    assert marks.union_max([(a.limit(0), "i"), (b.limit(0), "j")]).first().mark == 0
    games = spark.createDataFrame([("2024/25", 3), ("2023/24", 38)], "season string, gw int")
    assert marks.filtered_max(games, F.col("season") == "2024/25", "gw").first().mark == 3
    assert marks.filtered_max(games, F.col("season") == "2025/26", "gw").first().mark == 0


def test_increment_filter_drops_null_and_the_mark_itself(spark, rows):
    df = spark.createDataFrame([(None,), (5,), (6,)], "round int")
    mark = spark.createDataFrame([(5,)], "mark int")
    assert rows(filters.after_mark(df, "round", mark)) == [(6,)]


def test_league_filter(spark, rows):
    df = spark.createDataFrame([("EPL", 9), ("X", 1), ("X", 2), (None, None)], "l string, i int")
    assert rows(df.where(filters.in_league(F.col("l"), F.col("i")))) == [("EPL", 9), ("X", 1)]


def test_lookup_takes_the_first_and_never_matches_null(spark, rows):
    left = spark.createDataFrame([("A",), ("B",), (None,)], "k string")
    right = spark.createDataFrame([("A", 2, 20), ("A", 1, 10), (None, 0, 3)], "k string, o int, v int")
    assert rows(joins.lookup_first(left, right, "k", ["o"]), "k", "v") == [("A", 10), ("B", None), (None, None)]


def test_left_join_by_name_fans_out(spark, rows):
    left = spark.createDataFrame([("N",), ("M",)], "name string")
    right = spark.createDataFrame([("N", 1), ("N", 2), ("N", 2)], "name string, id int")
    assert rows(joins.left_by_name(left, right, "name")) == [("M", None), ("N", 1), ("N", 2)]


def test_null_safe_join(spark, rows):
    left = spark.createDataFrame([("a",), (None,)], "k string")
    right = spark.createDataFrame([(None, 1)], "k string, v int")
    assert rows(joins.left_null_safe(left, right, ["k"])) == [("a", None), (None, 1)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join_on_a_hot_key(spark, rows, how):
    left = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("k"), "id"
    )
    right = spark.range(0, 200, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain = rows(left.join(right, ["k"], how))
    assert rows(joins.salted_join(left, right, ["k"], how, 7)) == plain
    with pytest.raises(ValueError):
        joins.salted_join(left, right, ["k"], "right")


def test_large_sides_are_not_broadcast(spark):
    big = spark.range(10**9)
    for join in (joins.join_unique, joins.semi, joins.anti):
        plan = join(spark.range(10), big, ["id"])._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "Generate" not in plan  # nor is a side repeated


def test_null_keys_are_dealt_over_tasks(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.join_unique(left, spark.range(500).withColumnRenamed("id", "k").withColumn("v", F.lit(1)), ["k"])
        sizes = joined.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 1000 and max(r["count"] for r in sizes) < 500
        assert joined.where("v = 1").count() == 333
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_ordered_keys_with_an_outlier_and_nulls(spark):
    ids = list(range(2000)) + [10**15, None, None]
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "k long, v int")
    got = [(r.id, r.k) for r in keys.dense_keys(df, "k", ordered=True).orderBy("id").collect()]
    assert [i for i, _ in got] == list(range(1, 2004))
    assert [k for _, k in got] == [None, None, *range(2000), 10**15]


def test_first_per_key_limits_before_the_shuffle(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 3, "n")], "k string, o int, v string")
    first = dedupe.first_per_key(df, ["k"], ["o"])
    assert rows(first) == [("a", 1, "y"), (None, 3, "n")]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    with pytest.raises(ValueError):
        dedupe.first_per_key(df, ["k"], [])


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_results_do_not_depend_on_partitions(spark, rows, parts):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 11).alias("o"), "id")
    assert rows(dedupe.first_per_key(df.repartition(parts), ["k"], ["o"])) == rows(
        dedupe.first_per_key(df.coalesce(1), ["k"], ["o"])
    )


def test_top1_breaks_ties_by_ordinal(spark, rows):
    df = spark.createDataFrame([("q", 5.0, 2, "b"), ("q", 5.0, 1, "a"), ("q", 4.0, 0, "c")], "k string, s double, o int, v string")
    assert rows(dedupe.top1(df, ["k"], "s", "o", ["v"])) == [("q", "a", 5.0)]


def test_split_is_whole(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "id int")
    matched, unmatched = filters.split_matched(df, "id")
    assert (matched.count(), unmatched.count()) == (2, 1)
    status = spark.createDataFrame([("ok",), ("x",), (None,)], "status string")
    ok, bad = filters.split_status(status)
    assert (ok.count(), bad.count()) == (1, 2)


def test_union_scan_drops_null_once(spark, rows):
    a = spark.createDataFrame([("s", 1), ("s", None), ("t", 5)], "season string, id int")
    b = spark.createDataFrame([("s", 1), ("s", 2)], "season string, id int")
    assert rows(param_union([(a, "season", "id"), (b, "season", "id")], "s", "id")) == [(1,), (2,)]


def test_concat_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert rows(sets.concat_by_name(a, b)) == [(1, "x", None), (None, "y", 2.0)]


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "x")], "id int, name string")
    assert project.rename(df, {"id": "team_id", "absent": "z"}).columns == ["team_id", "name"]
    kept = project.with_literals(df, {"name": ("other", "string"), "season": ("2024/25", "string")})
    assert kept.first() == (1, "x", "2024/25")
    assert project.stamp_run_id(df, "r1").first().run_id == "r1"


def test_conform_fills_defaults_and_rounds_timestamps(spark):
    spec = TABLES["raw.understat_games"]
    df = spark.createDataFrame([(7, "2024-08-16 19:00:00.0006", "H", "A")], "understat_id long, date string, home string, away string")
    row = project.conform(df, spec.schema, spec.defaults).first()
    assert row.asDict() == {
        "understat_id": 7, "date": dt.datetime(2024, 8, 16, 19, 0, 0, 1000), "home": "H", "away": "A", "is_processed": False
    }


def test_dense_keys(spark):
    df = spark.range(0, 5000, 3).withColumnRenamed("id", "k")
    for ordered in (True, False):
        numbered = keys.dense_keys(df, "k", start=10, ordered=ordered, buckets=64)
        got = sorted((r.k, r.id) for r in numbered.collect())
        assert sorted(i for _, i in got) == list(range(11, 11 + len(got)))
        if ordered:
            assert [i for _, i in got] == list(range(11, 11 + len(got)))


def test_hashed_keys_depend_on_the_natural_key_alone(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 1)], "n string, g int")
    got = [r.k for r in df.select(keys.hashed_key("n", "g").alias("k")).collect()]
    assert got[0] == got[2] != got[1]


def test_constraint_checks(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1), ("b", None)], "name string, team_id int")
    assert rows(quality.unique_violations(df, ["name", "team_id"])) == [("a", 1, 2)]
    parent = spark.createDataFrame([(2,)], "id int")
    assert rows(quality.foreign_key_violations(df, "team_id", parent, "id")) == [(1, 4)]
    assert rows(quality.null_counts(df, ["name", "team_id"])) == [("name", 2), ("team_id", 1)]
    spec = TABLES["staging.understat_team_mapping"]
    teams = spark.createDataFrame([(1, "x")], "id int, name string")
    bad = quality.table_violations(df.union(df.where("name = 'b'")), spec, {"analytics.teams": teams})
    assert rows(bad, "check", "n") == [("not_null", 2), ("unique", 2)]


def test_batch_report(spark, rows):
    df = spark.createDataFrame([(1, 10, "ok", 3), (1, 12, "x", 9), (1, 11, None, 9), (2, 13, "ok", 1)], "batch_id int, id int, status string, p int")
    assert rows(marks.batch_counts(df, players="p")) == [(1, 1, 2, 3), (2, 1, 0, 1)]
    assert rows(marks.failed_ids(df, "id")) == [(1, 2, "11,12")]


def test_gaps(spark, rows):
    ids = spark.range(1, 6)
    found = spark.createDataFrame([(2,), (4,), (None,)], "id long")
    assert rows(joins.gaps(ids, found, "id")) == [(1,), (3,), (5,)]


def test_empty_frames_keep_their_schema(spark):
    schema = TABLES["raw.understat_games"].schema
    assert empty(spark, schema).schema == schema == from_records(spark, [], schema).schema


def test_declared_tables():
    assert len(TABLES) == 15
    assert len(HISTORY_MAPPING) == 33
    assert len(TABLES["raw.fpl_player_games"].schema) == 38
    assert TABLES["analytics.player_seasons"].not_null == ["player_id", "season"]
    assert sum(len(t.references) for t in TABLES.values()) == 8
    assert sum(len(t.unique) for t in TABLES.values()) == 8
