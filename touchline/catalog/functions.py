"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from touchline.catalog import Tables, query
from touchline.functions import casting, similarity, text
from touchline.functions.status import fetch_status
from touchline.operators.marks import batch_id


@query("fn_concat", "SELECT p_partkey, p_brand || ' ' || nullif(p_type, 'SMALL') AS name FROM part")
def fn_concat(t: Tables) -> DataFrame:
    name = text.full_name(F.col("p_brand"), F.nullif("p_type", F.lit("SMALL")))
    return t.part.select("p_partkey", name.alias("name"))


@query(
    "fn_cast_string",
    "SELECT o_orderkey, CAST(nullif(o_custkey, 7) AS VARCHAR) AS cust FROM orders",
)
def fn_cast_string(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", casting.text_key(F.nullif("o_custkey", F.lit(7))).alias("cust"))


@query(
    "fn_season",
    """
    SELECT o_orderkey, CAST(y AS VARCHAR) || '/' || right(CAST(y + 1 AS VARCHAR), 2) AS season
    FROM (SELECT o_orderkey,
                 year(o_orderdate) - CASE WHEN month(o_orderdate) >= 7 THEN 0 ELSE 1 END AS y FROM orders)
    """,
)
def fn_season(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", text.season_label(F.col("o_orderdate")).alias("season"))


@query(
    "fn_regex_extract",
    r"""
    SELECT page_id, nullif(regexp_extract(html, 'track\((\d+)\)', 1), '') AS track,
           nullif(regexp_extract(url, '[?&]page=(\d+)', 1), '') AS page
    FROM pages
    """,
)
def fn_regex_extract(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id",
        text.regex_capture(F.col("html"), r"track\((\d+)\)").alias("track"),
        text.regex_capture(F.col("url"), r"[?&]page=(\d+)").alias("page"),
    )


def _escape(value: Column) -> Column:
    r"""Write text the way pages embed it: ``\xHH`` for braces, quotes, colons and backslashes."""
    out = F.replace(value, F.lit("\\"), F.lit("\\x5C"))
    for ch in "{}\"':":
        out = F.replace(out, F.lit(ch), F.lit(f"\\x{ord(ch):02X}"))
    return F.replace(out, F.lit("\n"), F.lit("\\n"))


@query("fn_unescape", "SELECT page_id, html AS decoded FROM pages")
def fn_unescape(t: Tables) -> DataFrame:
    """Whole pages, escaped and decoded again."""
    return t.pages.select("page_id", text.decode_escapes(_escape(F.col("html"))).alias("decoded"))


@query(
    "fn_match_info",
    """
    SELECT page_id, CASE WHEN url LIKE '%/fr/%' THEN NULL ELSE url END AS team_h,
           CASE WHEN url LIKE '%/fr/%' THEN NULL ELSE CAST(page_id AS VARCHAR) END AS league_id
    FROM pages
    """,
)
def fn_match_info(t: Tables) -> DataFrame:
    """Match data embedded in a page; pages without it give NULL."""
    info = F.to_json(F.struct(F.col("page_id").alias("league_id"), F.col("url").alias("team_h")))
    script = F.concat(F.lit("var match_info  = JSON.parse('"), _escape(info), F.lit("');"))
    html = F.concat(F.col("html"), F.when(F.col("url").contains("/fr/"), "").otherwise(script))
    parsed = text.match_info(text.match_info_text(html))
    return t.pages.select("page_id", parsed["team_h"].alias("team_h"), parsed["league_id"].alias("league_id"))


@query(
    "fn_json_field",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
           CAST(NULL AS INTEGER) AS absent, 5 AS defaulted
    FROM events
    """,
)
def fn_json_field(t: Tables) -> DataFrame:
    parsed = F.from_json("props", "k int, absent int")
    return t.events.select(
        "event_id",
        parsed["k"].alias("k"),
        parsed["absent"].alias("absent"),
        casting.or_default(parsed["absent"], 5).alias("defaulted"),
    )


# Page and roster responses made from a page's address.
_PAGE_STATUS = "CASE WHEN url LIKE 'http:%' THEN NULL WHEN url LIKE '%.org%' THEN 404 ELSE 200 END"
_API_STATUS = "CASE WHEN url LIKE '%page=%' THEN NULL WHEN url LIKE '%#%' THEN 404 ELSE 200 END"
_LEAGUE = "CASE WHEN url LIKE '%/de/%' THEN 'EPL' ELSE 'other' END"


@query(
    "fn_status_case",
    f"""
    SELECT page_id,
           CASE WHEN ({_PAGE_STATUS}) IS NULL THEN 'understat_request_error'
                WHEN ({_PAGE_STATUS}) = 404 THEN 'understat_404_error'
                WHEN url LIKE '%/fr/%' THEN 'missing_match_data'
                WHEN {_LEAGUE} <> 'EPL' AND url NOT LIKE '%/en/%' THEN 'not_epl'
                WHEN ({_API_STATUS}) IS NULL THEN 'api_request_error'
                WHEN ({_API_STATUS}) = 404 THEN 'api_404_error'
                WHEN url LIKE '%//m.%' THEN 'api_decode_error'
                ELSE 'ok' END AS status
    FROM pages
    """,
)
def fn_status_case(t: Tables) -> DataFrame:
    url = F.col("url")
    info = F.when(
        ~url.contains("/fr/"),
        F.struct(
            F.when(url.contains("/de/"), "EPL").otherwise("other").alias("league"),
            F.when(url.contains("/en/"), 1).otherwise(9).alias("league_id"),
        ),
    )
    api_json = F.when(url.contains("//m."), "<html>").otherwise('{"rosters":{}}')
    status = fetch_status(F.expr(_PAGE_STATUS), info, F.expr(_API_STATUS), api_json)
    return t.pages.select("page_id", status.alias("status"))


def value_text() -> Column:
    """Event values as text; errors carry text that is no number, purchases none at all."""
    return (
        F.when(F.col("event_type") == "error", F.concat(F.col("user_id").cast("string"), F.lit(".5")))
        .when(F.col("event_type") == "purchase", F.lit(None))
        .otherwise(F.col("user_id").cast("string"))
    )


@query("fn_cast_strict", "SELECT event_id, CAST(user_id AS INTEGER) AS user_no, CAST(user_id AS DOUBLE) AS user_f FROM events")
def fn_cast_strict(t: Tables) -> DataFrame:
    shown = F.col("user_id").cast("string")
    return t.events.select(
        "event_id",
        casting.strict(shown, "int").alias("user_no"),
        casting.strict(shown, "double").alias("user_f"),
    )


@query(
    "fn_try_cast",
    "SELECT event_id, CAST(user_id AS INTEGER) AS user_no FROM events WHERE event_type NOT IN ('error', 'purchase')",
)
def fn_try_cast(t: Tables) -> DataFrame:
    return casting.lenient(t.events.select("event_id", value_text().alias("user_no")), {"user_no": "int"})[0]


@query(
    "fn_try_cast_rejects",
    """
    SELECT event_id, CASE event_type WHEN 'error' THEN user_id || '.5' END AS user_no
    FROM events WHERE event_type IN ('error', 'purchase')
    """,
)
def fn_try_cast_rejects(t: Tables) -> DataFrame:
    return casting.lenient(t.events.select("event_id", value_text().alias("user_no")), {"user_no": "int"})[1]


@query(
    "fn_date_parse",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS lenient_day
    FROM orders
    """,
)
def fn_date_parse(t: Tables) -> DataFrame:
    shown = F.date_format("o_orderdate", "MMM d yyyy")
    mixed = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(shown)
    return t.orders.select(
        "o_orderkey",
        text.iso_date(shown).alias("day"),
        text.iso_date(mixed, strict=False).alias("lenient_day"),
    )


@query("fn_cast_timestamp", "SELECT o_orderkey, o_orderdate + INTERVAL 19 HOUR AS at FROM orders")
def fn_cast_timestamp(t: Tables) -> DataFrame:
    shown = F.date_format("o_orderdate", "yyyy-MM-dd'T19:00:00Z'")
    return t.orders.select("o_orderkey", casting.naive_timestamp(shown).alias("at"))


@query("fn_batch_id", "SELECT o_orderkey, CAST(floor((o_orderkey + 50) / 25) AS BIGINT) + 1 AS batch_id FROM orders")
def fn_batch_id(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", batch_id(F.col("o_orderkey"), F.lit(-50)).alias("batch_id"))


def odd_name() -> Column:
    return F.concat(F.col("p_brand"), F.lit("-é "), F.upper("p_name"), F.lit(" _Š'x. "))


@query(
    "fn_normalise_name",
    """
    SELECT p_partkey, trim(lower(regexp_replace(regexp_replace(
        p_brand || '-é ' || upper(p_name) || ' _Š''x. ', '[\u0080-ÿ]', '', 'g'), '[^\\p{L}\\p{N}_]', ' ', 'g'))) AS norm
    FROM part
    """.replace("\\\\", "\\"),
)
def fn_normalise_name(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.normalise_name(odd_name()).alias("norm"))


# ---------------------------------------------------------------- similarity


def lcs_sql(a: str, b: str) -> str:
    """LCS length of two columns, up to 60 characters: one bit per letter of ``a``.

    Each letter of ``b`` becomes the mask of the places it has in ``a``; folding
    ``s -> (s + (s & m)) | (s - (s & m))`` over the masks clears one bit per LCS letter.
    """
    full = f"((CAST(1 AS BIGINT) << length({a})) - 1)"
    mask = (
        f"coalesce(list_sum(list_transform(range(1, length({a}) + 1), lambda at_:"
        f" CASE WHEN substr({a}, at_, 1) = ch_ THEN CAST(1 AS BIGINT) << (at_ - 1) ELSE 0 END)), 0)"
    )
    masks = f"list_transform(string_split({b}, ''), lambda ch_: CAST({mask} AS BIGINT))"
    step = f"((st_ + (st_ & m_)) | (st_ - (st_ & m_))) & {full}"
    fold = f"list_reduce(list_prepend({full}, {masks}), lambda st_, m_: {step})"
    return f"CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE length({a}) - bit_count({fold}) END"


def ratio_sql(a: str, b: str) -> str:
    return (
        f"CASE WHEN length({a}) + length({b}) = 0 THEN 100.0::DOUBLE"
        f" ELSE 100.0::DOUBLE * (2 * ({lcs_sql(a, b)})) / (length({a}) + length({b})) END"
    )


# Names to compare: the part name and a form of it altered by part type.
ALTERED_SQL = """CASE p_type
    WHEN 'ECONOMY' THEN string_split(p_name, ' ')[2] || ' ' || string_split(p_name, ' ')[1]
    WHEN 'SMALL' THEN substr(p_name, 1, 2) || substr(p_name, 4)
    WHEN 'STANDARD' THEN p_name || ' limited'
    WHEN 'PROMO' THEN upper(string_split(p_name, ' ')[2])
    WHEN 'LARGE' THEN 'the ' || substr(p_name, 3)
    ELSE replace(p_name, 'e', 'i') END"""


def altered() -> Column:
    name, words = F.col("p_name"), F.split("p_name", " ")
    kind = F.col("p_type")
    return (
        F.when(kind == "ECONOMY", F.concat_ws(" ", words[1], words[0]))
        .when(kind == "SMALL", F.concat(F.substring(name, 1, 2), F.substr(name, F.lit(4))))
        .when(kind == "STANDARD", F.concat(name, F.lit(" limited")))
        .when(kind == "PROMO", F.upper(words[1]))
        .when(kind == "LARGE", F.concat(F.lit("the "), F.substr(name, F.lit(3))))
        .otherwise(F.replace(name, F.lit("e"), F.lit("i")))
    )


def name_pairs(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.col("p_name").alias("a"), F.lower(altered()).alias("b"))


PAIRS_SQL = f"pairs AS (SELECT p_partkey, p_name AS a, lower({ALTERED_SQL}) AS b FROM part)"


@query(
    "fn_sim_lev",
    f"""
    WITH {PAIRS_SQL}
    SELECT p_partkey, 100.0::DOUBLE * (greatest(length(a), length(b)) - levenshtein(a, b))
           / greatest(length(a), length(b)) AS score FROM pairs
    """,
)
def fn_sim_lev(t: Tables) -> DataFrame:
    return name_pairs(t).select("p_partkey", similarity.lev(F.col("a"), F.col("b")).alias("score"))


@query("fn_sim_indel", f"WITH {PAIRS_SQL} SELECT p_partkey, {ratio_sql('a', 'b')} AS score FROM pairs")
def fn_sim_indel(t: Tables) -> DataFrame:
    return name_pairs(t).select("p_partkey", similarity.indel(F.col("a"), F.col("b")).alias("score"))


def sorted_sql(a: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split({a}, ' '), lambda x: x <> '')), ' ')"


@query(
    "fn_sim_token_sort",
    f"""
    WITH {PAIRS_SQL}, s AS (SELECT p_partkey, {sorted_sql('a')} AS a, {sorted_sql('b')} AS b FROM pairs)
    SELECT p_partkey, {ratio_sql('a', 'b')} AS score FROM s
    """,
)
def fn_sim_token_sort(t: Tables) -> DataFrame:
    return name_pairs(t).select("p_partkey", similarity.token_sort(F.col("a"), F.col("b")).alias("score"))


def token_set_ctes(source: str, keys: str) -> str:
    """CTEs ending in ``token_set``: ``keys`` and ``set_score`` for columns a, b of ``source``."""
    words = lambda c: f"list_sort(list_distinct(list_filter(string_split({c}, ' '), lambda x: x <> '')))"
    return f"""
    ts_words AS (SELECT {keys}, {words('a')} AS wa, {words('b')} AS wb FROM {source}),
    ts_parts AS (
        SELECT {keys}, length(array_to_string(list_filter(wa, lambda x: list_contains(wb, x)), ' ')) AS sect,
               array_to_string(list_filter(wa, lambda x: NOT list_contains(wb, x)), ' ') AS da,
               array_to_string(list_filter(wb, lambda x: NOT list_contains(wa, x)), ' ') AS db
        FROM ts_words
    ),
    ts_sized AS (
        SELECT *, sect + (sect > 0)::INT + length(da) AS la, sect + (sect > 0)::INT + length(db) AS lb,
               {lcs_sql('da', 'db')} AS rest
        FROM ts_parts
    ),
    token_set AS (
        SELECT {keys}, CASE WHEN sect > 0 AND (da = '' OR db = '') THEN 100.0::DOUBLE ELSE greatest(
            100.0::DOUBLE * (2 * (rest + sect + (sect > 0)::INT)) / (la + lb),
            CASE WHEN sect > 0 THEN greatest(100.0::DOUBLE * (2 * sect) / (sect + la),
                                             100.0::DOUBLE * (2 * sect) / (sect + lb)) ELSE 0 END) END AS set_score
        FROM ts_sized
    )"""


@query(
    "fn_sim_token_set",
    f"WITH {PAIRS_SQL}, {token_set_ctes('pairs', 'p_partkey')} SELECT p_partkey, set_score AS score FROM token_set",
)
def fn_sim_token_set(t: Tables) -> DataFrame:
    return name_pairs(t).select("p_partkey", similarity.token_set(F.col("a"), F.col("b")).alias("score"))


def combined_ctes(source: str, keys: str) -> str:
    """CTEs ending in ``combined``: ``keys``, a, b and ``score`` for normalised a, b of ``source``."""
    long = "greatest(length(a), length(b))"
    short = "least(length(a), length(b))"
    return f"""
    c_near AS (SELECT * FROM {source} WHERE {long} < 1.5 * {short}),
    c_far AS (SELECT * FROM {source} WHERE {long} >= 1.5 * {short}),
    {token_set_ctes('c_near', keys)},
    c_near_sorted AS (SELECT {keys}, {sorted_sql('a')} AS a, {sorted_sql('b')} AS b FROM c_near),
    c_near_sort AS (SELECT {keys}, {ratio_sql('a', 'b')} AS sort_score FROM c_near_sorted),
    c_near_score AS (
        SELECT {keys}, greatest({ratio_sql('a', 'b')}, greatest(sort_score, set_score) * 0.95::DOUBLE) AS score
        FROM c_near JOIN c_near_sort USING ({keys}) JOIN token_set USING ({keys})
    ),
    c_forms AS (
        SELECT {keys}, 0 AS form, a, b FROM c_far
        UNION ALL SELECT {keys}, 1, {sorted_sql('a')}, {sorted_sql('b')} FROM c_far
        UNION ALL SELECT {keys}, 2,
            array_to_string(list_sort(list_distinct(list_filter(string_split(a, ' '), lambda x: x <> ''))), ' '),
            array_to_string(list_sort(list_distinct(list_filter(string_split(b, ' '), lambda x: x <> ''))), ' ')
        FROM c_far
    ),
    c_needles AS (
        SELECT {keys}, form, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s,
               CASE WHEN length(a) <= length(b) THEN b ELSE a END AS l FROM c_forms
        UNION
        SELECT {keys}, form, b, a FROM c_forms WHERE length(a) = length(b)
    ),
    c_windows AS (
        SELECT DISTINCT s, l, substr(l, greatest(k, 0) + 1, least(k + length(s), length(l)) - greatest(k, 0)) AS w
        FROM (SELECT DISTINCT s, l, unnest(range(1 - length(s), length(l))) AS k FROM c_needles)
    ),
    c_partial AS (SELECT s, l, max({ratio_sql('s', 'w')}) AS p FROM c_windows GROUP BY s, l),
    c_far_forms AS (
        SELECT {keys}, max(CASE WHEN form = 0 THEN p END) AS whole, max(CASE WHEN form > 0 THEN p END) AS token
        FROM c_needles JOIN c_partial USING (s, l) GROUP BY {keys}
    ),
    c_far_score AS (
        SELECT {keys}, greatest({ratio_sql('a', 'b')},
            whole * (CASE WHEN {long} <= 8 * {short} THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END),
            (CASE WHEN list_has_any(list_filter(string_split(a, ' '), lambda x: x <> ''), string_split(b, ' '))
                  THEN 100.0::DOUBLE ELSE token END) * 0.95::DOUBLE
            * (CASE WHEN {long} <= 8 * {short} THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END)) AS score
        FROM c_far JOIN c_far_forms USING ({keys})
    ),
    combined AS (SELECT * FROM c_near_score UNION ALL SELECT * FROM c_far_score)"""


@query(
    "fn_sim_combined",
    f"WITH {PAIRS_SQL}, {combined_ctes('pairs', 'p_partkey')} SELECT p_partkey, score FROM combined",
)
def fn_sim_combined(t: Tables) -> DataFrame:
    return name_pairs(t).select("p_partkey", similarity.combined(F.col("a"), F.col("b")).alias("score"))
