"""The jobs, end to end, on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from touchline.catalog import Tables, query
from touchline.catalog.functions import ALTERED_SQL, _escape, altered
from touchline.catalog.fuzzy import fuzzy_ctes, masters
from touchline.catalog.sources import history_payloads
from touchline.operators.filters import split_status
from touchline.operators.marks import batch_counts, filtered_max, union_max
from touchline.plans import matches, player_games, players, teams
from touchline.session import fresh_dir, materialise
from touchline.sources.tables import param_union
from touchline.streaming.ingest import insert_available


@query(
    "resolve_players",
    f"""
    WITH {fuzzy_ctes(80)},
    known_ids AS (
        SELECT p_partkey FROM part WHERE p_size <= 25 AND p_type = 'ECONOMY'
    )
    SELECT asked.p_partkey AS fpl_seasonal_id, asked.name,
           coalesce(k.p_partkey, best.id) AS player_id,
           CASE WHEN k.p_partkey IS NULL THEN 2 ELSE 1 END AS match_step,
           CASE WHEN k.p_partkey IS NULL THEN best.b END AS match_name,
           CASE WHEN k.p_partkey IS NULL THEN best.score END AS score
    FROM asked LEFT JOIN known_ids k USING (p_partkey) LEFT JOIN best USING (a)
    """,
)
def resolve_players(t: Tables) -> DataFrame:
    """Some players are known by source id, the others are found by name or not at all."""
    source = t.part.select(
        F.col("p_partkey").alias("fpl_seasonal_id"),
        altered().alias("name"),
        F.concat(F.lit("k"), F.col("p_partkey").cast("string")).alias("opta_id"),
    )
    known = t.part.where("p_size <= 25").select(
        F.col("p_partkey").alias("id"),
        F.col("p_partkey").alias("player_id"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("k"), F.col("p_partkey").cast("string"))).alias("opta_id"),
    )
    return players.resolve(source, known, ["id"]).drop("opta_id")


@query(
    "resolve_teams",
    f"""
    WITH {fuzzy_ctes(90)},
    mapped AS (SELECT DISTINCT p_name AS name, CAST(p_size AS BIGINT) AS team_id FROM part WHERE p_size <= 2)
    SELECT asked.p_partkey AS fpl_team_id, asked.name, coalesce(m.team_id, best.id) AS team_id,
           CASE WHEN m.team_id IS NULL THEN best.b END AS match_name,
           CASE WHEN m.team_id IS NULL THEN best.score END AS score
    FROM asked LEFT JOIN mapped m ON m.name = asked.name LEFT JOIN best USING (a)
    """,
)
def resolve_teams(t: Tables) -> DataFrame:
    source = teams.source_teams(t.part.select(F.col("p_partkey").alias("id"), altered().alias("name")))
    mapped = t.part.where("p_size <= 2").select(
        F.col("p_name").alias("name"), F.col("p_size").cast("long").alias("team_id")
    )
    return teams.resolve(source, mapped, masters(t), ["id"])


INCREMENT_SQL = """
    WITH known AS (
        SELECT p_partkey AS id FROM part WHERE p_type = 'ECONOMY'
        UNION SELECT l_partkey FROM lineitem WHERE l_returnflag = 'ECONOMY'
    )
    SELECT CAST(l_partkey AS INTEGER) AS fpl_player_id, p.p_brand AS opta_id, p.p_size AS fpl_team_id,
           CAST(i AS INTEGER) AS gameweek, l_shipdate AS fpl_datetime,
           CAST(l_suppkey AS INTEGER) AS opponent_fpl_team_id, CAST(l_quantity AS INTEGER) AS minutes_played,
           l_linenumber + 0.5::DOUBLE AS expected_goals, 'run-7' AS run_id
    FROM lineitem JOIN known ON known.id = l_partkey
    LEFT JOIN part p ON p.p_partkey = l_partkey AND p.p_size > 5, generate_series(1, 7) AS s(i)
    WHERE i <= l_linenumber AND l_returnflag <> 'R'
      AND i > (SELECT coalesce(max(n_regionkey), 0) FROM nation WHERE n_name <> 'NATION_3')
"""


@query("increment_player_games", INCREMENT_SQL)
def increment_player_games(t: Tables) -> DataFrame:
    """Mark, known ids, unopened payloads, increment, lookup and mapping."""
    payloads = history_payloads(t.lineitem).withColumn("player_id", F.col("player_id").cast("int"))
    elements = t.part.where("p_size > 5").select(
        F.col("p_partkey").cast("int").alias("id"),
        F.col("p_brand").alias("code"),
        F.col("p_size").alias("team"),
        F.lit(0).alias("pos"),
    )
    ids = param_union(
        [(t.part, "p_type", "p_partkey"), (t.lineitem, "l_returnflag", "l_partkey")], "ECONOMY", "player_id"
    ).select(F.col("player_id").cast("int"))
    mark = filtered_max(t.nation, F.col("n_name") != "NATION_3", "n_regionkey")
    rows = player_games.increment(payloads, elements, ids, mark)
    return rows.select(
        "fpl_player_id", "opta_id", "fpl_team_id", "gameweek", "fpl_datetime", "opponent_fpl_team_id",
        "minutes_played", "expected_goals", F.lit("run-7").alias("run_id"),
    )


def match_pages(t: Tables) -> DataFrame:
    """Pages with embedded match data; French ones lack it, German ones are another league."""
    url = F.col("url")
    info = F.to_json(
        F.struct(
            F.when(url.contains("/de/"), "other").otherwise("EPL").alias("league"),
            F.lit("9").alias("league_id"),
            url.alias("team_h"),
            F.concat(F.lit("away-"), F.col("page_id").cast("string")).alias("team_a"),
            F.lit("2024-08-16 19:00:00").alias("date"),
        )
    )
    script = F.concat(F.lit("<script>var match_info = JSON.parse('"), _escape(info), F.lit("');</script>"))
    return t.pages.select(
        F.col("page_id").alias("understat_game_id"),
        F.when(url.startswith("http:"), F.lit(None)).otherwise(200).cast("int").alias("page_status"),
        F.concat("html", F.when(url.contains("/fr/"), "").otherwise(script)).alias("page_html"),
    )


def match_rosters(t: Tables) -> DataFrame:
    """A roster per document: two players at home; one away, or an empty list."""
    def player(name, minutes):
        return F.struct(
            name.alias("player"), minutes.alias("time"),
            *[F.lit(v).alias(k) for k, v in (("shots", "1"), ("goals", "0"), ("assists", "2"), ("xG", "0.25"), ("xA", "0.5"), ("key_passes", "3"))],
        )

    minutes = (F.col("doc_id") % 91).cast("string")
    home = F.create_map(F.lit("1"), player(F.col("source"), minutes), F.lit("2"), player(F.lit("sub"), F.lit("10")))
    away = F.create_map(F.lit("3"), player(F.col("lang"), minutes))
    text = F.concat(
        F.lit('{"rosters":{"h":'), F.to_json(home), F.lit(',"a":'),
        F.when(F.col("lang") == "en", F.lit("[]")).otherwise(F.to_json(away)), F.lit("}}"),
    )
    return t.documents.select(
        F.col("doc_id").alias("understat_game_id"),
        F.when(F.col("source") == "src1", 404).otherwise(200).alias("api_status"),
        text.alias("api_json"),
    )


MATCH_SQL = """
    fetched AS (
        SELECT page_id, url, lang, source, doc_id,
               CASE WHEN url LIKE 'http:%' THEN 'understat_request_error'
                    WHEN url LIKE '%/fr/%' THEN 'missing_match_data'
                    WHEN url LIKE '%/de/%' THEN 'not_epl'
                    WHEN doc_id IS NULL THEN 'api_request_error'
                    WHEN source = 'src1' THEN 'api_404_error' ELSE 'ok' END AS status
        FROM pages LEFT JOIN documents ON doc_id = page_id
    ),
    players AS (
        SELECT page_id AS understat_game_id, url AS team, source AS name, CAST(page_id % 91 AS INTEGER) AS minutes_played
        FROM fetched WHERE status = 'ok'
        UNION ALL SELECT page_id, url, 'sub', 10 FROM fetched WHERE status = 'ok'
        UNION ALL SELECT page_id, 'away-' || page_id, lang, CAST(page_id % 91 AS INTEGER) FROM fetched
        WHERE status = 'ok' AND lang <> 'en'
    )"""


@query(
    "ingest_matches",
    f"""
    WITH {MATCH_SQL}
    SELECT understat_game_id, team, name, minutes_played, 1 AS shots, 0 AS goals, 2 AS assists,
           0.25::DOUBLE AS expected_goals, 0.5::DOUBLE AS expected_assists, 3 AS key_passes FROM players
    """,
)
def ingest_matches(t: Tables) -> DataFrame:
    """Players of all accepted matches: page, embedded data, league, roster, sides, casts."""
    ok, _ = split_status(materialise(matches.classify(match_pages(t), match_rosters(t)), "matches"))
    return matches.player_rows(ok).select(
        "understat_game_id", "team", "name", "minutes_played", "shots", "goals", "assists",
        "expected_goals", "expected_assists", "key_passes",
    )


@query(
    "ingest_match_games",
    f"""
    WITH {MATCH_SQL}
    SELECT page_id AS understat_id, TIMESTAMP '2024-08-16 19:00:00' AS date, url AS home, 'away-' || page_id AS away
    FROM fetched WHERE status = 'ok'
    """,
)
def ingest_match_games(t: Tables) -> DataFrame:
    ok, _ = split_status(materialise(matches.classify(match_pages(t), match_rosters(t)), "matches"))
    return matches.games(ok)


@query(
    "ingest_match_report",
    f"""
    WITH {MATCH_SQL},
    mark AS (SELECT max(page_id) AS m FROM pages),
    ids AS (SELECT m + i AS id, CAST(floor((i + 50) / 25) AS BIGINT) + 1 AS batch_id FROM mark, generate_series(-50, 150) AS s(i))
    SELECT batch_id, count(*) FILTER (status = 'ok') AS fetched,
           count(*) FILTER (coalesce(status, 'none') <> 'ok') AS failed
    FROM ids LEFT JOIN fetched ON page_id = id GROUP BY batch_id
    """,
)
def ingest_match_report(t: Tables) -> DataFrame:
    """Counts per chunk of the candidate ids around the mark."""
    mark = union_max([(t.pages, "page_id")])
    return batch_counts(matches.attempt(match_pages(t), match_rosters(t), mark))


@query(
    "incr_stream",
    """
    SELECT o_custkey, o_orderkey, o_orderstatus FROM (
        SELECT o_custkey, o_orderkey, o_orderstatus, row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders
    ) WHERE rn = 1
    """,
)
def incr_stream(t: Tables) -> DataFrame:
    """First order per customer through a stream that is stopped and started again."""
    schema = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus").schema
    run = fresh_dir(t.spark, "incr-stream")
    for _ in range(2):
        source = t.spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(t.root)
        insert_available(source, f"{run}/target", ["o_custkey"], ["o_orderkey"], f"{run}/checkpoint")
    return t.spark.read.schema(schema).parquet(f"{run}/target")
