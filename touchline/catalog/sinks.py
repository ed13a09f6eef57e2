"""Write planning and constraint checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from touchline.catalog import Tables, query
from touchline.operators.keys import dense_keys
from touchline.operators.project import conform, stamp_run_id
from touchline.operators.quality import foreign_key_violations, null_counts, unique_violations
from touchline.schemas import TABLES
from touchline.sinks import planning

LINE_KEYS = ["l_orderkey", "l_linenumber"]

# The batch holds every order, those in process twice; finished orders are stored already.
BATCH_SQL = """
    batch AS (
        SELECT o_orderkey, o_custkey, 1 AS seq FROM orders
        UNION ALL
        SELECT o_orderkey, o_custkey + 1, 2 FROM orders WHERE o_orderstatus = 'P'
        UNION ALL
        SELECT o_orderkey, o_custkey + 1, 2 FROM orders WHERE o_orderstatus = 'P'
    ),
    target AS (SELECT o_orderkey, o_custkey, 0 AS seq FROM orders WHERE o_orderstatus = 'F'),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq, o_custkey) AS rn FROM batch
    ),
    inserted AS (
        SELECT o_orderkey, o_custkey, seq FROM ranked
        WHERE rn = 1 AND o_orderkey NOT IN (SELECT o_orderkey FROM target)
    )"""


def order_batch(t: Tables) -> DataFrame:
    first = t.orders.select("o_orderkey", "o_custkey", F.lit(1).alias("seq"))
    again = t.orders.where("o_orderstatus = 'P'").select(
        "o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"), F.lit(2).alias("seq")
    )
    return first.union(again).union(again)


def order_target(t: Tables) -> DataFrame:
    return t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", F.lit(0).alias("seq"))


# Lines repeat their key; returned lines are stored already.
LINE_SQL = """
    lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem),
    line_target AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'),
    line_ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey
        ) AS rn FROM lines
    ),
    line_inserted AS (
        SELECT r.* EXCLUDE (rn) FROM line_ranked r
        WHERE rn = 1 AND NOT EXISTS (
            SELECT 1 FROM line_target x
            WHERE x.l_orderkey = r.l_orderkey AND x.l_linenumber = r.l_linenumber
        )
    )"""


def lines(t: Tables) -> DataFrame:
    return t.lineitem.select(*LINE_KEYS, "l_partkey", "l_suppkey", "l_shipdate")


def line_target(t: Tables) -> DataFrame:
    return t.lineitem.where("l_returnflag = 'R'").select(*LINE_KEYS)


def lines_inserted(t: Tables) -> DataFrame:
    return planning.insert_absent(
        lines(t), line_target(t), LINE_KEYS, ["l_shipdate", "l_partkey", "l_suppkey"]
    )


def orders_inserted(t: Tables) -> DataFrame:
    return planning.insert_absent(order_batch(t), order_target(t), ["o_orderkey"], ["seq"])


@query(
    "sink_append",
    """
    SELECT event_id, user_id, 'before' AS run_id FROM events WHERE event_type = 'view'
    UNION ALL
    SELECT event_id, user_id, 'run-2' FROM events
    """,
)
def sink_append(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id")
    before = stamp_run_id(t.events.where("event_type = 'view'").select("event_id", "user_id"), "before")
    return before.union(stamp_run_id(rows, "run-2"))


@query("sink_insert_absent", f"WITH {BATCH_SQL} SELECT * FROM inserted")
def sink_insert_absent(t: Tables) -> DataFrame:
    return orders_inserted(t)


@query("sink_insert_absent_composite", f"WITH {LINE_SQL} SELECT * FROM line_inserted")
def sink_insert_absent_composite(t: Tables) -> DataFrame:
    return lines_inserted(t)


@query("sink_returning_inserted", f"WITH {BATCH_SQL} SELECT o_orderkey FROM inserted")
def sink_returning_inserted(t: Tables) -> DataFrame:
    inserted, _ = planning.returning(order_batch(t), order_target(t), ["o_orderkey"], ["seq"])
    return inserted.select("o_orderkey")


@query(
    "sink_returning_skipped",
    f"""
    WITH {BATCH_SQL},
    counted AS (
        SELECT b.o_orderkey, b.o_custkey, b.seq, count(*) AS n FROM batch b
        GROUP BY b.o_orderkey, b.o_custkey, b.seq
    )
    SELECT c.o_orderkey, c.o_custkey, c.seq,
           c.n - CASE WHEN i.o_orderkey IS NULL THEN 0 ELSE 1 END AS copies
    FROM counted c LEFT JOIN inserted i
      ON i.o_orderkey = c.o_orderkey AND i.o_custkey = c.o_custkey AND i.seq = c.seq
    WHERE c.n - CASE WHEN i.o_orderkey IS NULL THEN 0 ELSE 1 END > 0
    """,
)
def sink_returning_skipped(t: Tables) -> DataFrame:
    _, skipped = planning.returning(order_batch(t), order_target(t), ["o_orderkey"], ["seq"])
    return skipped


@query(
    "sink_metrics",
    f"""
    WITH {BATCH_SQL}, {LINE_SQL}
    SELECT (SELECT count(*) FROM inserted) AS games_inserted,
           (SELECT count(*) FROM batch) AS games_total,
           (SELECT count(*) FROM line_inserted) AS players_inserted,
           (SELECT count(*) FROM lines) AS players_total
    """,
)
def sink_metrics(t: Tables) -> DataFrame:
    return planning.metrics(
        {
            "games_inserted": orders_inserted(t),
            "games_total": order_batch(t),
            "players_inserted": lines_inserted(t),
            "players_total": lines(t),
        }
    )


@query(
    "sink_pair",
    f"""
    WITH {BATCH_SQL}, {LINE_SQL}
    SELECT 'game' AS target, o_orderkey AS game_id, CAST(NULL AS INTEGER) AS player, 'run-1' AS run_id
    FROM inserted
    UNION ALL
    SELECT 'player', l_orderkey, l_linenumber, 'run-1' FROM line_inserted
    """,
)
def sink_pair(t: Tables) -> DataFrame:
    games = orders_inserted(t).select(
        F.lit("game").alias("target"),
        F.col("o_orderkey").alias("game_id"),
        F.lit(None).cast("int").alias("player"),
    )
    players = lines_inserted(t).select(
        F.lit("player").alias("target"), F.col("l_orderkey").alias("game_id"), F.col("l_linenumber").alias("player")
    )
    return stamp_run_id(games.union(players), "run-1")


@query(
    "sink_strict_violations",
    f"""
    WITH {LINE_SQL}
    SELECT l.l_orderkey, l.l_linenumber, count(*) AS n_rows, bool_or(x.l_orderkey IS NOT NULL) AS in_target
    FROM lines l LEFT JOIN line_target x
      ON x.l_orderkey = l.l_orderkey AND x.l_linenumber = l.l_linenumber
    GROUP BY l.l_orderkey, l.l_linenumber
    HAVING count(*) > 1 OR bool_or(x.l_orderkey IS NOT NULL)
    """,
)
def sink_strict_violations(t: Tables) -> DataFrame:
    return planning.strict_violations(lines(t), line_target(t), LINE_KEYS)


@query(
    "sink_replay_idempotent",
    f"""
    WITH {BATCH_SQL} SELECT * FROM target UNION ALL SELECT * FROM inserted
    """,
)
def sink_replay_idempotent(t: Tables) -> DataFrame:
    """The target after the same batch, as large as the target, was inserted twice."""
    once = planning.replayed(order_target(t), order_batch(t), ["o_orderkey"], ["seq"], merge=True)
    return planning.replayed(once, order_batch(t), ["o_orderkey"], ["seq"], merge=True)


@query("stamp_run_id", "SELECT event_id, event_type, 'manual__1' AS run_id FROM events")
def stamp(t: Tables) -> DataFrame:
    return stamp_run_id(t.events.select("event_id", "event_type"), "manual__1")


@query(
    "conform_schema",
    """
    SELECT c_name AS name, '2024/25' AS season, CAST(c_custkey AS INTEGER) AS fpl_seasonal_id,
           CAST(NULL AS VARCHAR) AS opta_id, CAST(NULL AS INTEGER) AS "position",
           FALSE AS is_processed
    FROM customer
    """,
)
def conform_schema(t: Tables) -> DataFrame:
    rows = t.customer.select(
        F.lit("2024/25").alias("season"), F.col("c_custkey").alias("fpl_seasonal_id"), F.col("c_name").alias("name"), "c_acctbal"
    )
    spec = TABLES["raw.fpl_player_manual_review"]
    return conform(rows, spec.schema, spec.defaults)


@query(
    "surrogate_dense",
    """
    SELECT o_orderkey, 100 + row_number() OVER (ORDER BY o_orderkey) AS id FROM orders
    """,
)
def surrogate_dense(t: Tables) -> DataFrame:
    return dense_keys(t.orders.select("o_orderkey"), "o_orderkey", start=100, ordered=True)


@query(
    "surrogate_dense_hashed",
    """
    SELECT count(*) AS n, CAST(1 AS BIGINT) AS lowest, count(*) AS highest, count(*) AS n_distinct
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    """,
)
def surrogate_dense_hashed(t: Tables) -> DataFrame:
    """Numbers given in hash order: as many as rows, from 1 on, without gaps."""
    numbered = dense_keys(t.lineitem.select(*LINE_KEYS).distinct(), LINE_KEYS)
    return numbered.agg(
        F.count("id").alias("n"),
        F.min("id").alias("lowest"),
        F.max("id").alias("highest"),
        F.count_distinct("id").alias("n_distinct"),
    )


@query(
    "check_unique",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
)
def check_unique(t: Tables) -> DataFrame:
    return unique_violations(t.lineitem, LINE_KEYS)


@query(
    "check_fk",
    """
    SELECT l_orderkey, count(*) AS n_rows FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
    GROUP BY l_orderkey
    """,
)
def check_fk(t: Tables) -> DataFrame:
    return foreign_key_violations(
        t.lineitem, "l_orderkey", t.orders.where("o_orderstatus <> 'F'"), "o_orderkey"
    )


@query(
    "check_not_null",
    """
    WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT 'lang' AS column_name, count(*) FILTER (lang IS NULL) AS n_nulls FROM j
    UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL) FROM j
    UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM j
    """,
)
def check_not_null(t: Tables) -> DataFrame:
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return null_counts(joined, ["lang", "quality", "toxic"])
