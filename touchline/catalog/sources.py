"""Readers and flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from touchline.catalog import Tables, query
from touchline.functions.text import regex_capture
from touchline.operators.marks import candidate_ids, union_max
from touchline.session import spread
from touchline.sources import payloads
from touchline.sources.tables import param_union, scan, scan_distinct


@query(
    "src_json_array",
    """
    SELECT 0 AS pos, CAST(o_orderkey AS INTEGER) AS id, o_orderstatus AS first_name,
           o_orderpriority AS second_name, o_custkey AS code, 1 AS element_type,
           CAST(NULL AS INTEGER) AS team
    FROM orders
    UNION ALL
    SELECT 1, CAST(o_custkey AS INTEGER), NULL, o_orderpriority, o_orderkey, 2, 7
    FROM orders WHERE o_orderstatus = 'F'
    """,
)
def src_json_array(t: Tables) -> DataFrame:
    """Payloads of one or two players; absent fields come back as NULL."""
    first = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("first_name"),
        F.col("o_orderpriority").alias("second_name"),
        F.col("o_custkey").alias("code"),
        F.lit(1).alias("element_type"),
        F.lit(None).cast("int").alias("team"),
    )
    second = F.struct(
        F.col("o_custkey").alias("id"),
        F.lit(None).cast("string").alias("first_name"),
        F.col("o_orderpriority").alias("second_name"),
        F.col("o_orderkey").alias("code"),
        F.lit(2).alias("element_type"),
        F.lit(7).alias("team"),
    )
    elements = F.when(F.col("o_orderstatus") == "F", F.array(first, second)).otherwise(F.array(first))
    orders = spread(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))
    docs = orders.select(F.to_json(F.struct(elements.alias("elements"))).alias("payload"))
    return payloads.players(docs)


@query(
    "src_json_teams",
    """
    SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name FROM customer
    UNION ALL
    SELECT c_nationkey, c_mktsegment FROM customer
    """,
)
def src_json_teams(t: Tables) -> DataFrame:
    teams = F.array(
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        F.struct(F.col("c_nationkey").cast("long").alias("id"), F.col("c_mktsegment").alias("name")),
    )
    docs = t.customer.select(F.to_json(F.struct(teams.alias("teams"))).alias("payload"))
    return payloads.teams(docs)


def history_payloads(lineitem: DataFrame) -> DataFrame:
    """One payload per line item: a history as long as its line number; returned items have none."""
    record = lambda i: F.struct(
        i.alias("round"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("kickoff_time"),
        F.col("l_suppkey").alias("opponent_team"),
        F.col("l_quantity").cast("int").alias("minutes"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(".5")).alias("expected_goals"),
    )
    history = F.transform(F.sequence(F.lit(1), F.col("l_linenumber")), record)
    payload = F.when(F.col("l_returnflag") == "R", F.lit('{"fixtures":[]}')).otherwise(
        F.to_json(F.struct(history.alias("history")))
    )
    rows = lineitem.select("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    return spread(rows).select(F.col("l_partkey").alias("player_id"), payload.alias("payload"))


@query(
    "src_history_explode",
    """
    SELECT l_partkey AS player_id, CAST(i AS INTEGER) AS round,
           strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS kickoff_time,
           CAST(l_quantity AS INTEGER) AS minutes, l_linenumber || '.5' AS expected_goals,
           CAST(NULL AS INTEGER) AS starts
    FROM lineitem, generate_series(1, 7) AS s(i)
    WHERE i <= l_linenumber AND l_returnflag <> 'R'
    """,
)
def src_history_explode(t: Tables) -> DataFrame:
    return payloads.histories(history_payloads(t.lineitem)).select(
        "player_id", "round", "kickoff_time", "minutes", "expected_goals", "starts"
    )


@query(
    "src_html_extract",
    r"""
    SELECT page_id, nullif(regexp_extract(html, '<title>([^<]+)</title>', 1), '') AS title,
           TRY_CAST(nullif(regexp_extract(html, 'track\((\d+)\)', 1), '') AS BIGINT) AS track
    FROM pages
    """,
)
def src_html_extract(t: Tables) -> DataFrame:
    html = F.col("html")
    return t.pages.select(
        "page_id",
        regex_capture(html, r"<title>([^<]+)</title>").alias("title"),
        regex_capture(html, r"track\((\d+)\)").cast("long").alias("track"),
    )


@query(
    "src_map_explode",
    """
    SELECT event_id, 'h' AS side, event_type AS player, CAST(user_id AS VARCHAR) AS time,
           CAST(NULL AS VARCHAR) AS shots FROM events
    UNION ALL
    SELECT event_id, 'h', 'second', '1', CAST(user_id AS VARCHAR) FROM events
    UNION ALL
    SELECT event_id, 'a', event_type, '2', NULL FROM events WHERE event_type <> 'error'
    """,
)
def src_map_explode(t: Tables) -> DataFrame:
    """Two players at home, one away; an away side sent as ``[]`` gives no rows."""
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    key = F.col("event_id").cast("string")
    home = F.create_map(
        key,
        F.struct(kind.alias("player"), user.alias("time"), F.lit(None).cast("string").alias("shots")),
        F.lit("x"),
        F.struct(F.lit("second").alias("player"), F.lit("1").alias("time"), user.alias("shots")),
    )
    away = F.create_map(key, F.struct(kind.alias("player"), F.lit("2").alias("time")))
    doc = F.concat(
        F.lit('{"rosters":{"h":'),
        F.to_json(home),
        F.lit(',"a":'),
        F.when(kind == "error", F.lit("[]")).otherwise(F.to_json(away)),
        F.lit("}}"),
    )
    events = spread(t.events.select("event_id", "user_id", "event_type"))
    docs = events.select("event_id", doc.alias("doc"))
    return payloads.explode_rosters(docs, "doc", ("event_id",)).select(
        "event_id", "side", "player", "time", "shots"
    )


@query("scan_project", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def scan_project(t: Tables) -> DataFrame:
    return scan(t.customer, "c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query("scan_distinct", "SELECT DISTINCT p_name, p_brand FROM part")
def scan_distinct_names(t: Tables) -> DataFrame:
    return scan_distinct(t.part, "p_name", "p_brand")


@query(
    "scan_param_union",
    """
    SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F'
    UNION
    SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F'
    """,
)
def scan_param_union(t: Tables) -> DataFrame:
    return param_union(
        [(t.orders, "o_orderstatus", "o_orderkey"), (t.lineitem, "l_linestatus", "l_orderkey")], "F", "id"
    )


@query(
    "range_candidates",
    """
    SELECT m.mark + i AS id
    FROM (SELECT CAST(coalesce(max(o_orderkey), 0) AS BIGINT) AS mark FROM orders) m,
         generate_series(-50, 150) AS s(i)
    """,
)
def range_candidates(t: Tables) -> DataFrame:
    return candidate_ids(union_max([(t.orders, "o_orderkey")]))
