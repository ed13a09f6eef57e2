"""Projections, filters, joins, aggregates, first rows and unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from touchline.catalog import Tables, query
from touchline.operators import dedupe, filters, joins, marks, project, sets
from touchline.schemas import LOOK_BACK


# ---------------------------------------------------------------- projection


@query("project_rename", "SELECT s_suppkey AS team_id, s_name AS name FROM supplier")
def project_rename(t: Tables) -> DataFrame:
    pruned = project.prune(t.supplier, ["s_suppkey", "s_name"])
    return project.rename(pruned, {"s_suppkey": "team_id", "s_name": "name", "absent": "ignored"})


@query("project_drop", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def project_drop(t: Tables) -> DataFrame:
    return t.supplier.drop("s_nationkey")


@query(
    "project_literal",
    """
    SELECT p_partkey, p_name, '2024/25' AS season, CAST(NULL AS INTEGER) AS player_id FROM part
    """,
)
def project_literal(t: Tables) -> DataFrame:
    values = {"season": ("2024/25", "string"), "player_id": (None, "int"), "p_name": ("kept", "string")}
    return project.with_literals(t.part.select("p_partkey", "p_name"), values)


@query(
    "project_mapping",
    """
    SELECT CAST(l_linenumber AS INTEGER) AS gameweek, l_shipdate AS fpl_datetime,
           CAST(l_suppkey AS INTEGER) AS opponent_fpl_team_id,
           CAST(l_quantity AS DOUBLE) AS minutes_played, CAST(l_partkey AS VARCHAR) AS name,
           CAST(NULL AS INTEGER) AS starts
    FROM lineitem
    """,
)
def project_mapping(t: Tables) -> DataFrame:
    mapping = [
        ("l_linenumber", "gameweek", "int"),
        ("l_shipdate", "fpl_datetime", "timestamp_ntz"),
        ("l_suppkey", "opponent_fpl_team_id", "int"),
        ("l_quantity", "minutes_played", "double"),
        ("l_partkey", "name", "string"),
        ("absent", "starts", "int"),
    ]
    return project.project_mapping(t.lineitem, mapping)


# ------------------------------------------------------------------- filters


@query("filter_eq_param", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'")
def filter_eq_param(t: Tables) -> DataFrame:
    rows = filters.equals(t.orders, "o_orderpriority", "1-URGENT")
    return rows.select("o_orderkey", "o_orderpriority")


@query(
    "filter_after_hwm",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate > (SELECT max(l_shipdate) FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')
    """,
)
def filter_after_hwm(t: Tables) -> DataFrame:
    mark = t.lineitem.where("l_shipdate < timestamp_ntz'1998-01-01'").agg(F.max("l_shipdate"))
    return filters.after_mark(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", mark)


@query(
    "filter_disjunction",
    """
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE coalesce(nullif(c_mktsegment, 'MACHINERY') = 'BUILDING', FALSE)
       OR coalesce(CAST(nullif(c_nationkey, 3) AS VARCHAR) = '1', FALSE)
    """,
)
def filter_disjunction(t: Tables) -> DataFrame:
    league = F.nullif("c_mktsegment", F.lit("MACHINERY"))
    league_id = F.nullif("c_nationkey", F.lit(3))
    rows = filters.either(t.customer, league == "BUILDING", league_id.cast("string") == "1")
    return rows.select("c_custkey", "c_mktsegment")


def customers_with_orders(t: Tables) -> DataFrame:
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey"
    )
    return t.customer.select("c_custkey", "c_name").join(urgent, "c_custkey", "left")


_CUSTOMER_ORDERS = """
    SELECT c_custkey, c_name, o_orderkey FROM customer
    LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') ON o_custkey = c_custkey
"""


@query("split_matched", f"SELECT * FROM ({_CUSTOMER_ORDERS}) WHERE o_orderkey IS NOT NULL")
def split_matched(t: Tables) -> DataFrame:
    return filters.split_matched(customers_with_orders(t), "o_orderkey")[0]


@query("split_unmatched", f"SELECT * FROM ({_CUSTOMER_ORDERS}) WHERE o_orderkey IS NULL")
def split_unmatched(t: Tables) -> DataFrame:
    return filters.split_matched(customers_with_orders(t), "o_orderkey")[1]


@query(
    "filter_dropna",
    """
    SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)
    WHERE l.quality IS NOT NULL AND nullif(d.lang, 'de') IS NOT NULL
    """,
)
def filter_dropna(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", F.nullif("lang", F.lit("de")).alias("lang"))
    labels = t.labels.select("doc_id", "quality")
    return filters.require(docs.join(labels, "doc_id", "left"), ["quality", "lang"])


def page_status(url: str = "url") -> Column:
    """A status per page from its address, to stand in for a fetch."""
    return (
        F.when(F.col(url).contains("/de/"), "not_epl")
        .when(F.col(url).contains("page="), "api_404_error")
        .when(~F.col(url).startswith("https"), F.lit(None))
        .otherwise("ok")
    )


PAGE_STATUS_SQL = """CASE WHEN url LIKE '%/de/%' THEN 'not_epl' WHEN url LIKE '%page=%' THEN 'api_404_error'
    WHEN url NOT LIKE 'https%' THEN NULL ELSE 'ok' END"""


@query("filter_status", f"SELECT page_id, 'ok' AS status FROM pages WHERE {PAGE_STATUS_SQL} = 'ok'")
def filter_status(t: Tables) -> DataFrame:
    return filters.split_status(t.pages.select("page_id", page_status().alias("status")))[0]


@query(
    "filter_status_rejects",
    f"""
    SELECT page_id, {PAGE_STATUS_SQL} AS status FROM pages
    WHERE coalesce({PAGE_STATUS_SQL} <> 'ok', TRUE)
    """,
)
def filter_status_rejects(t: Tables) -> DataFrame:
    return filters.split_status(t.pages.select("page_id", page_status().alias("status")))[1]


# --------------------------------------------------------------------- joins


@query(
    "join_lookup_first",
    """
    WITH first AS (
        SELECT l_partkey, l_suppkey, row_number() OVER (
            PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_suppkey) AS rn
        FROM lineitem WHERE l_returnflag = 'R'
    )
    SELECT CAST(p.p_partkey AS VARCHAR) AS key, p.p_name, f.l_suppkey
    FROM part p LEFT JOIN first f ON f.rn = 1 AND f.l_partkey = p.p_partkey
    """,
)
def join_lookup_first(t: Tables) -> DataFrame:
    """First supplier a part was returned to; parts never returned get NULL."""
    parts = t.part.select(F.col("p_partkey").alias("key"), "p_name")
    supplied = t.lineitem.where("l_returnflag = 'R'").select(
        F.col("l_partkey").alias("key"), "l_shipdate", "l_orderkey", "l_suppkey"
    )
    found = joins.lookup_first(parts, supplied, "key", ["l_shipdate", "l_orderkey", "l_suppkey"])
    return found.select("key", "p_name", "l_suppkey")


@query(
    "join_left_name",
    """
    SELECT o_orderkey, o_orderpriority AS name, m.team_id
    FROM orders LEFT JOIN (
        SELECT DISTINCT c_mktsegment AS segment, c_nationkey AS team_id FROM customer WHERE c_nationkey < 3
    ) m ON m.segment = CASE o_orderstatus WHEN 'F' THEN 'BUILDING' WHEN 'O' THEN 'MACHINERY' ELSE 'none' END
    """,
)
def join_left_name(t: Tables) -> DataFrame:
    """A name mapped to several ids gives several rows; an unmapped one keeps its row."""
    segment = F.when(F.col("o_orderstatus") == "F", "BUILDING").when(F.col("o_orderstatus") == "O", "MACHINERY").otherwise("none")
    left = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("name"), segment.alias("segment"))
    right = t.customer.where("c_nationkey < 3").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("team_id")
    )
    return joins.left_by_name(left, right, "segment").drop("segment")


@query(
    "join_null_safe",
    """
    WITH j AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
    m AS (SELECT quality, count(*) AS n FROM j GROUP BY quality)
    SELECT j.doc_id, j.quality, m.n FROM j LEFT JOIN m ON j.quality IS NOT DISTINCT FROM m.quality
    """,
)
def join_null_safe(t: Tables) -> DataFrame:
    j = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    m = j.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    return joins.left_null_safe(j, m, ["quality"])


@query(
    "join_lookup_meta",
    """
    SELECT o_orderkey, o_custkey, c_name, c_nationkey
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_mktsegment <> 'BUILDING'
    """,
)
def join_lookup_meta(t: Tables) -> DataFrame:
    meta = t.customer.where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"
    )
    return joins.join_unique(t.orders.select("o_orderkey", "o_custkey"), meta, ["o_custkey"], "left")


@query(
    "join_lookup_salted",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, p_brand
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_type <> 'ECONOMY'
    """,
)
def join_lookup_salted(t: Tables) -> DataFrame:
    """The same lookup along the way taken when the right side is too large to broadcast."""
    brands = t.part.where("p_type <> 'ECONOMY'").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.salted_join(items, brands, ["l_partkey"], "left", salts=4)


@query(
    "join_inner_payload",
    f"""
    SELECT page_id, url, lang FROM pages JOIN documents ON doc_id = page_id
    WHERE {PAGE_STATUS_SQL} = 'ok'
    """,
)
def join_inner_payload(t: Tables) -> DataFrame:
    ok = filters.split_status(t.pages.select("page_id", "url", page_status().alias("status")))[0]
    docs = t.documents.select(F.col("doc_id").alias("page_id"), "lang")
    return ok.drop("status").join(docs, "page_id")


@query("join_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def join_semi(t: Tables) -> DataFrame:
    placed = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.semi(t.customer.select("c_custkey", "c_name"), placed, ["c_custkey"])


@query("join_anti", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def join_anti(t: Tables) -> DataFrame:
    placed = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti(t.customer.select("c_custkey", "c_name"), placed, ["c_custkey"])


@query(
    "join_side_map",
    """
    SELECT l_orderkey, l_linenumber,
           CASE l_linestatus WHEN 'F' THEN 'team-' || l_suppkey WHEN 'O' THEN l_returnflag END AS team
    FROM lineitem
    """,
)
def join_side_map(t: Tables) -> DataFrame:
    side = F.when(F.col("l_linestatus") == "F", "h").when(F.col("l_linestatus") == "O", "a")
    home = F.concat(F.lit("team-"), F.col("l_suppkey").cast("string"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", joins.side_team(side, home, F.col("l_returnflag")).alias("team")
    )


@query(
    "join_range_gaps",
    """
    SELECT m.mark + i AS id
    FROM (SELECT max(o_orderkey) AS mark FROM orders) m, generate_series(-50, 150) AS s(i)
    WHERE m.mark + i NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
    """,
)
def join_range_gaps(t: Tables) -> DataFrame:
    ids = marks.candidate_ids(marks.union_max([(t.orders, "o_orderkey")]))
    return joins.gaps(ids, t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id")), "id")


# ---------------------------------------------------------------- aggregates


@query(
    "hwm_union_max",
    """
    SELECT CAST(coalesce(max(id), 0) AS BIGINT) AS mark
    FROM (SELECT o_orderkey AS id FROM orders UNION SELECT l_orderkey FROM lineitem)
    """,
)
def hwm_union_max(t: Tables) -> DataFrame:
    return marks.union_max([(t.orders, "o_orderkey"), (t.lineitem, "l_orderkey")])


@query("hwm_filtered_max", "SELECT coalesce(max(l_linenumber), 0) AS mark FROM lineitem WHERE l_returnflag = 'A'")
def hwm_filtered_max(t: Tables) -> DataFrame:
    return marks.filtered_max(t.lineitem, F.col("l_returnflag") == "A", "l_linenumber")


@query("hwm_empty", "SELECT coalesce(max(l_linenumber), 0) AS mark FROM lineitem WHERE l_returnflag = 'none'")
def hwm_empty(t: Tables) -> DataFrame:
    return marks.filtered_max(t.lineitem, F.col("l_returnflag") == "none", "l_linenumber")


@query("agg_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def agg_distinct(t: Tables) -> DataFrame:
    return t.part.select("p_brand", "p_type").distinct()


@query(
    "agg_dedupe_first",
    """
    SELECT l_partkey, l_orderkey, l_suppkey FROM (
        SELECT l_partkey, l_orderkey, l_suppkey, row_number() OVER (
            PARTITION BY l_partkey ORDER BY l_orderkey, l_suppkey) AS rn FROM lineitem
    ) WHERE rn = 1
    """,
)
def agg_dedupe_first(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_partkey", "l_orderkey", "l_suppkey")
    return dedupe.first_per_key(rows, ["l_partkey"], ["l_orderkey", "l_suppkey"])


def batched_orders(t: Tables) -> DataFrame:
    first = t.orders.agg(F.min("o_orderkey")).scalar()
    status = F.when(F.col("o_orderstatus") == "P", "api_404_error").otherwise("ok")
    return t.orders.select(
        "o_orderkey",
        marks.batch_id(F.col("o_orderkey"), first).alias("batch_id"),
        status.alias("status"),
        (F.col("o_custkey") % 11).alias("n_players"),
    )


_BATCH = "CAST(floor((o_orderkey - (SELECT min(o_orderkey) FROM orders)) / 25) AS BIGINT) + 1"


@query(
    "agg_per_batch",
    f"""
    SELECT {_BATCH} AS batch_id, count(*) FILTER (o_orderstatus <> 'P') AS fetched,
           count(*) FILTER (o_orderstatus = 'P') AS failed,
           CAST(coalesce(sum(o_custkey % 11) FILTER (o_orderstatus <> 'P'), 0) AS BIGINT) AS players
    FROM orders GROUP BY 1
    """,
)
def agg_per_batch(t: Tables) -> DataFrame:
    return marks.batch_counts(batched_orders(t), players="n_players")


@query(
    "agg_failed_ids",
    """
    SELECT CAST(floor((page_id - (SELECT min(page_id) FROM pages)) / 25) AS BIGINT) + 1 AS batch_id,
           count(*) AS failed, string_agg(CAST(page_id AS VARCHAR), ',' ORDER BY page_id) AS failed_ids
    FROM pages WHERE coalesce("""
    + PAGE_STATUS_SQL
    + """ <> 'ok', TRUE) GROUP BY 1
    """,
)
def agg_failed_ids(t: Tables) -> DataFrame:
    first = t.pages.agg(F.min("page_id")).scalar()
    rows = t.pages.select(
        "page_id",
        marks.batch_id(F.col("page_id"), first).alias("batch_id"),
        page_status().alias("status"),
    )
    return marks.failed_ids(rows, "page_id")


# ------------------------------------------------------- first row and top-1


@query(
    "window_first_per_key",
    """
    SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey FROM (
        SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, row_number() OVER (
            PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey) AS rn FROM lineitem
    ) WHERE rn = 1
    """,
)
def window_first_per_key(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey")
    order = [F.col("l_shipdate").desc(), "l_linenumber", "l_partkey"]
    return dedupe.first_per_key(rows, ["l_orderkey"], order)


@query(
    "top1_tiebreak",
    """
    SELECT l_orderkey, l_partkey, score FROM (
        SELECT l_orderkey, l_partkey, l_quantity AS score, row_number() OVER (
            PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey) AS rn FROM lineitem
    ) WHERE rn = 1
    """,
)
def top1_tiebreak(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_partkey", F.col("l_quantity").alias("score"))
    return dedupe.top1(rows, ["l_orderkey"], "score", "l_partkey", ["l_partkey"])


# -------------------------------------------------------------------- unions


@query("set_union_distinct", "SELECT o_orderkey AS id FROM orders UNION SELECT l_orderkey FROM lineitem")
def set_union_distinct(t: Tables) -> DataFrame:
    return sets.union_distinct([(t.orders, "o_orderkey"), (t.lineitem, "l_orderkey")], "id")


@query(
    "set_union_by_name",
    """
    SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL
    SELECT s_name, s_nationkey, NULL, s_acctbal FROM supplier
    """,
)
def set_union_by_name(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return sets.concat_by_name(customers, suppliers)


@query(
    "incr_lookback",
    f"""
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderkey BETWEEN (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'F') - {LOOK_BACK}
                         AND (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'F') + 150
    """,
)
def incr_lookback(t: Tables) -> DataFrame:
    mark = marks.filtered_max(t.orders, F.col("o_orderstatus") == "F", "o_orderkey")
    return marks.in_look_back(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", mark)
