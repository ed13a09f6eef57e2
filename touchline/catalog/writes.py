"""Units of writes into stored tables, and what cannot be stored or read."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from touchline.catalog import Tables, query
from touchline.operators.marks import filtered_max
from touchline.operators.quality import with_violations
from touchline.plans import player_games
from touchline.session import fresh_dir
from touchline.sinks.writers import Unit, append, insert_if_absent
from touchline.sources import payloads
from touchline.sources.tables import Warehouse, param_union
from touchline.streaming.ingest import run_available

GAMES, PLAYERS = "raw.understat_games", "raw.understat_player_games"
MAPPED, TEAMS = "staging.fpl_team_mapping", "analytics.teams"


def warehouse(t: Tables, enforce=("not_null", "foreign_key")) -> Warehouse:
    return Warehouse(t.spark, fresh_dir(t.spark, "warehouse"), enforce)


def team_rows(t: Tables) -> DataFrame:
    """Customers as team mappings: some lack a season or a name, nation 0 is nobody's team."""
    return t.customer.select(
        F.when(F.col("c_nationkey") != 3, F.lit("2024/25")).alias("season"),
        F.col("c_custkey").cast("int").alias("fpl_team_id"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("name"),
        F.col("c_nationkey").cast("int").alias("team_id"),
    )


TEAM_ROWS_SQL = """
    team_rows AS (
        SELECT CASE WHEN c_nationkey <> 3 THEN '2024/25' END AS season,
               CAST(c_custkey AS INTEGER) AS fpl_team_id,
               CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS name,
               CAST(c_nationkey AS INTEGER) AS team_id
        FROM customer
    )"""


@query(
    "write_violations",
    f"""
    WITH {TEAM_ROWS_SQL}
    SELECT fpl_team_id, concat_ws(',',
        CASE WHEN season IS NULL THEN 'not_null season' END,
        CASE WHEN name IS NULL THEN 'not_null name' END,
        CASE WHEN team_id NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 1)
             THEN 'foreign_key team_id' END) AS violated
    FROM team_rows
    WHERE season IS NULL OR name IS NULL
       OR team_id NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 1)
    """,
)
def write_violations(t: Tables) -> DataFrame:
    """What each row of a batch breaks."""
    parents = {"team_id": t.nation.where("n_regionkey <> 1").select(F.col("n_nationkey").alias("id"))}
    checked = with_violations(team_rows(t), ["season", "name"], parents)
    return checked.where(F.size("violated") > 0).select("fpl_team_id", F.array_join("violated", ",").alias("violated"))


@query(
    "write_lenient",
    f"""
    WITH {TEAM_ROWS_SQL}, found AS (
        SELECT *, season IS NOT NULL AND name IS NOT NULL AND team_id BETWEEN 1 AND (SELECT count(*) FROM nation) AS good
        FROM team_rows
    )
    SELECT fpl_team_id, team_id, CASE WHEN good THEN 'stored' ELSE 'set aside' END AS state FROM found
    """,
)
def write_lenient(t: Tables) -> DataFrame:
    """Rows that break a constraint come back, the others are stored. Teams have ids from 1 on."""
    wh = warehouse(t)
    append(wh, TEAMS, t.nation.select(F.col("n_name").alias("name")))
    with Unit(wh, lenient=True) as unit:
        out = unit.insert_if_absent(MAPPED, team_rows(t), ["name"])
    stored = wh.read(MAPPED).select("fpl_team_id", "team_id", F.lit("stored").alias("state"))
    return stored.union(out.violations.select("fpl_team_id", "team_id", F.lit("set aside")))


def order_games(t: Tables, status: str) -> DataFrame:
    return t.orders.where(F.col("o_orderstatus") == status).select(
        F.col("o_orderkey").cast("int").alias("understat_id"),
        F.lit("2024-08-16 19:00:00").alias("date"),
        F.lit("H").alias("home"),
        F.col("o_orderpriority").alias("away"),
    )


def line_players(t: Tables, status: str) -> DataFrame:
    """Line items as players of their order; several share a name."""
    orders = t.orders.where(F.col("o_orderstatus") == status).select(F.col("o_orderkey").alias("l_orderkey"))
    lines = t.lineitem.join(orders, "l_orderkey", "left_semi")
    return lines.select(
        F.col("l_orderkey").cast("int").alias("understat_game_id"),
        F.concat(F.lit("line-"), F.col("l_linenumber").cast("string")).alias("name"),
        F.col("l_partkey").cast("string").alias("team"),
        F.col("l_suppkey").alias("pos"),
        *[F.lit(n).alias(c) for n, c in enumerate(["minutes_played", "shots", "goals", "assists", "expected_goals", "expected_assists", "key_passes"])],
    )


@query(
    "sink_pair_atomic",
    """
    WITH seen AS (SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P')),
    ranked AS (
        SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey, CAST(l_partkey AS VARCHAR)) AS rn
        FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM seen)
    )
    SELECT 'game' AS target, CAST(o_orderkey AS INTEGER) AS game_id, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS team
    FROM seen
    UNION ALL
    SELECT 'player', CAST(l_orderkey AS INTEGER), 'line-' || l_linenumber, CAST(l_partkey AS VARCHAR) FROM ranked WHERE rn = 1
    """,
)
def sink_pair_atomic(t: Tables) -> DataFrame:
    """Two tables after three runs, the second one cut off between its two writes.

    Of the players of one (match, name) the first of the payload is stored.
    """
    wh = warehouse(t)
    for status in "FOP":
        unit = Unit(wh, f"run-{status}")
        unit.insert_if_absent(GAMES, order_games(t, status), ["home", "away"])
        if status == "O":
            continue  # the run ends here and never commits
        unit.insert_if_absent(PLAYERS, line_players(t, status), ["pos"], ["understat_game_id", "name"])
        unit.commit()
    none = F.lit(None).cast("string")
    games = wh.read(GAMES).select(F.lit("game").alias("target"), F.col("understat_id").alias("game_id"), none.alias("name"), none.alias("team"))
    return games.union(wh.read(PLAYERS).select(F.lit("player"), "understat_game_id", "name", "team"))


@query(
    "sink_returning_writer",
    """
    WITH batch AS (
        SELECT CAST(o_orderkey AS INTEGER) AS k, o_orderpriority AS away, 'H' AS home FROM orders
        UNION ALL SELECT CAST(o_orderkey AS INTEGER), o_orderpriority, 'Z' FROM orders WHERE o_orderstatus = 'P'
    )
    SELECT 'inserted' AS outcome, k AS understat_id, home, CAST(1 AS BIGINT) AS copies FROM batch
    WHERE home = 'H' AND k NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    UNION ALL
    SELECT 'skipped', k, home, CAST(1 AS BIGINT) FROM batch
    WHERE home = 'Z' OR k IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    """,
)
def sink_returning_writer(t: Tables) -> DataFrame:
    """A writer's inserted and skipped rows: finished orders are stored, those in process come twice."""
    wh = warehouse(t)
    insert_if_absent(wh, GAMES, order_games(t, "F"), ["home"])
    every = order_games(t, "F").union(order_games(t, "O")).union(order_games(t, "P"))
    again = order_games(t, "P").withColumn("home", F.lit("Z"))
    with Unit(wh) as unit:
        out = unit.insert_if_absent(GAMES, every.union(again), ["home"])
    added = out.rows.select(F.lit("inserted").alias("outcome"), "understat_id", "home", F.lit(1).cast("long").alias("copies"))
    return added.union(out.skipped.select(F.lit("skipped"), "understat_id", "home", "copies"))


@query(
    "sink_id_ranges",
    """
    SELECT count(*) AS n, CAST(1 AS BIGINT) AS lowest, count(*) AS highest, count(*) AS n_distinct
    FROM (SELECT c_name FROM customer UNION ALL SELECT p_name FROM part)
    """,
)
def sink_id_ranges(t: Tables) -> DataFrame:
    """Ids of two appends: one after the other, without gaps, from ranges kept in the log."""
    wh = warehouse(t)
    append(wh, TEAMS, t.customer.select(F.col("c_name").alias("name")))
    append(wh, TEAMS, t.part.select(F.col("p_name").alias("name")))
    return wh.read(TEAMS).agg(
        F.count("id").alias("n"), F.min("id").alias("lowest"), F.max("id").alias("highest"), F.count_distinct("id").alias("n_distinct")
    )


@query(
    "commit_report",
    """
    SELECT 'run-F' AS batch, 'raw.understat_games' AS target, count(*) AS inserted, count(*) AS total
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT 'run-all', 'raw.understat_games', count(*) FILTER (o_orderstatus <> 'F'), count(*) FROM orders
    """,
)
def commit_report(t: Tables) -> DataFrame:
    """Counts per committed batch, as the log keeps them: no stored table is read."""
    wh = warehouse(t)
    with Unit(wh, "run-F") as unit:
        unit.insert_if_absent(GAMES, order_games(t, "F"), ["home"])
    with Unit(wh, "run-all") as unit:
        every = order_games(t, "F").union(order_games(t, "O")).union(order_games(t, "P"))
        unit.insert_if_absent(GAMES, every, ["home"])
    return wh.report()


@query(
    "resolve_first_wins",
    """
    SELECT player_id, name FROM (
        SELECT p_size AS player_id, p_name AS name, row_number() OVER (
            PARTITION BY p_size ORDER BY CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 2 END, p_partkey) AS rn
        FROM part
    ) WHERE rn = 1
    """,
)
def resolve_first_wins(t: Tables) -> DataFrame:
    """Of rows resolved to one player, a match by id comes first, then the place in the payload."""
    wh = warehouse(t, ["not_null"])
    rows = t.part.select(
        F.col("p_size").cast("int").alias("player_id"),
        F.lit("2024/25").alias("season"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_type") == "ECONOMY", 1).otherwise(2).alias("match_step"),
        F.col("p_partkey").alias("pos"),
    )
    insert_if_absent(wh, "staging.fpl_player_mapping", rows, ["match_step", "pos"])
    return wh.read("staging.fpl_player_mapping").select("player_id", "name")


def odd_histories(t: Tables) -> DataFrame:
    """Histories by line number: no list, good, with a non-record, with bad numbers, cut short, none."""
    round_ = F.col("l_partkey").cast("string")
    record = F.concat(F.lit('{"round":'), round_)
    n = F.col("l_linenumber") % 7
    payload = (
        F.when(n == 0, F.lit('{"history":"x"}'))
        .when(n == 1, F.concat(F.lit('{"history":['), record, F.lit("}]}")))
        .when(n == 2, F.concat(F.lit('{"history":['), record, F.lit("},7]}")))
        .when(n == 3, F.concat(F.lit('{"history":['), record, F.lit(".5}]}")))
        .when(n == 4, F.concat(F.lit('{"history":['), record))
        .when(n == 5, F.concat(F.lit('{"history":['), record, F.lit(',"expected_goals":"abc"}]}')))
        .otherwise(F.lit("{}"))
    )
    return t.lineitem.select(F.col("l_suppkey").cast("int").alias("player_id"), payload.alias("payload"))


ODD_SQL = """
    odd AS (
        SELECT CAST(l_suppkey AS INTEGER) AS player_id, l_partkey AS r, l_linenumber % 7 AS n FROM lineitem
    ), rejects AS (
        SELECT player_id, r, n,
               CASE n WHEN 2 THEN 1 WHEN 3 THEN 0 WHEN 5 THEN 0 END AS pos,
               CASE n WHEN 0 THEN 'payload has no history: it is no list'
                      WHEN 2 THEN 'element of history is no object'
                      WHEN 3 THEN 'round: ' || r || '.5'
                      WHEN 4 THEN 'payload has no history: it is no object'
                      WHEN 5 THEN 'expected_goals: abc' END AS problem
        FROM odd WHERE n IN (0, 2, 3, 4, 5)
    )"""


@query("src_history_rejects", f"WITH {ODD_SQL} SELECT player_id, pos, problem FROM rejects")
def src_history_rejects(t: Tables) -> DataFrame:
    _, bad = payloads.histories_lenient(odd_histories(t))
    return bad.select("player_id", "pos", "problem")


@query(
    "increment_rejects",
    f"""
    WITH {ODD_SQL}, known AS (SELECT s_suppkey AS id FROM supplier WHERE s_nationkey <= 12),
    mark AS (SELECT coalesce(max(n_nationkey), 0) AS m FROM nation WHERE n_regionkey <> 4)
    SELECT player_id, pos, problem, CAST(NULL AS INTEGER) AS gameweek FROM rejects, mark
    WHERE player_id IN (SELECT id FROM known) AND (n <> 5 OR r > m)
    UNION ALL
    SELECT player_id, NULL, NULL, CAST(r AS INTEGER) FROM odd, mark
    WHERE player_id IN (SELECT id FROM known) AND n IN (1, 2) AND r > m
    """,
)
def increment_rejects(t: Tables) -> DataFrame:
    """New records of known players, and what of their payloads cannot be read."""
    ids = param_union([(t.supplier.withColumn("known", F.col("s_nationkey") <= 12), "known", "s_suppkey")], True, "player_id")
    mark = filtered_max(t.nation, F.col("n_regionkey") != 4, "n_nationkey")
    elements = t.supplier.select(F.col("s_suppkey").alias("id"), F.lit(1).alias("code"), F.lit(1).alias("team"), F.lit(0).alias("pos"))
    good, bad = player_games.increment_lenient(odd_histories(t), elements, ids.select(F.col("player_id").cast("int")), mark)
    none = lambda ty: F.lit(None).cast(ty)
    return bad.select("player_id", "pos", "problem", none("int").alias("gameweek")).union(
        good.select("fpl_player_id", none("int"), none("string"), "gameweek")
    )


@query(
    "src_master_rejects",
    """
    SELECT CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS pos,
           CASE WHEN o_orderstatus = 'F' THEN 'id: x' || o_orderkey ELSE 'code: ' || o_custkey || '.5' END AS problem
    FROM orders WHERE o_orderstatus IN ('F', 'P')
    UNION ALL
    SELECT NULL, 'payload has no elements: it is missing' FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 10 = 0
    """,
)
def src_master_rejects(t: Tables) -> DataFrame:
    """Master payloads: a wrong id, a wrong code in a second element, or no elements at all."""
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    payload = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit('{"elements":[{"id":"x'), key, F.lit('","code":1}]}')))
        .when(F.col("o_orderstatus") == "P", F.concat(F.lit('{"elements":[{"id":1},{"id":2.0,"code":'), cust, F.lit(".5}]}")))
        .when(F.col("o_orderkey") % 10 == 0, F.lit('{"teams":[]}'))
        .otherwise(F.concat(F.lit('{"elements":[{"id":'), key, F.lit("}]}")))
    )
    _, bad = payloads.players_lenient(t.orders.select(payload.alias("payload")))
    return bad.select("pos", "problem")


@query(
    "incr_stream_batches",
    """
    SELECT CAST(o_custkey AS INTEGER) AS understat_id, min('landing-' || (o_orderkey % 3)) AS home FROM orders GROUP BY o_custkey
    """,
)
def incr_stream_batches(t: Tables) -> DataFrame:
    """Three landings, read file by file in many micro-batches; the first landing of a key wins.

    Each micro-batch is a named unit, so one that is replayed is not written twice.
    """
    wh = warehouse(t)
    run = fresh_dir(t.spark, "landed")
    for k in range(3):
        landing = t.orders.where(F.col("o_orderkey") % 3 == k).select(
            F.col("o_custkey").cast("int").alias("understat_id"),
            F.lit("2024-08-16 19:00:00").alias("date"),
            F.lit(f"landing-{k}").alias("home"),
            F.lit("A").alias("away"),
        )
        landing.write.parquet(f"{run}/files/{k}")
        schema = landing.schema

    def each(batch: DataFrame, number: int) -> None:
        for _ in range(2):  # the second time stands for a replay
            with Unit(wh, f"stream#{number}") as unit:
                unit.insert_if_absent(GAMES, batch, ["home"])

    source = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{run}/files/*")
    run_available(source, each, f"{run}/checkpoint")
    return wh.read(GAMES).select("understat_id", "home")
