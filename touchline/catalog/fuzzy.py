"""The fuzzy name join, against SQL that scores every pair of distinct names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from touchline.catalog import Tables, query
from touchline.catalog.functions import ALTERED_SQL, altered, combined_ctes
from touchline.operators.fuzzy import fuzzy_join


def fuzzy_ctes(threshold: int) -> str:
    """CTEs ending in ``best``: the best master per distinct query name."""
    return f"""
    masters AS (SELECT p_name AS b, min(p_partkey) AS id FROM part WHERE p_size <= 25 GROUP BY p_name),
    asked AS (SELECT p_partkey, {ALTERED_SQL} AS name, lower({ALTERED_SQL}) AS a FROM part),
    name_pairs AS (
        SELECT row_number() OVER () AS pair, a, b, id FROM (SELECT DISTINCT a FROM asked), masters
    ),
    {combined_ctes('name_pairs', 'pair')},
    best AS (
        SELECT a, b, id, CAST(round_even(score, 0) AS INTEGER) AS score FROM (
            SELECT a, b, id, score, row_number() OVER (PARTITION BY a ORDER BY score DESC, id) AS rn
            FROM combined JOIN name_pairs USING (pair)
        ) WHERE rn = 1 AND round_even(score, 0) >= {threshold}
    )"""


def asked(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", altered().alias("name"))


def masters(t: Tables) -> DataFrame:
    return t.part.where("p_size <= 25").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("id"))


def fuzzy_sql(threshold: int) -> str:
    return f"""
    WITH {fuzzy_ctes(threshold)}
    SELECT p_partkey, name, best.id AS id, best.b AS match_name, best.score
    FROM asked LEFT JOIN best USING (a)
    """


@query("join_fuzzy_top1", fuzzy_sql(80))
def join_fuzzy_top1(t: Tables) -> DataFrame:
    """Part names, altered by part type, matched to the names of the smaller parts."""
    return fuzzy_join(asked(t), masters(t), "id", ["id"], threshold=80)


@query("join_fuzzy_top1_90", fuzzy_sql(90))
def join_fuzzy_top1_90(t: Tables) -> DataFrame:
    return fuzzy_join(asked(t), masters(t), "id", ["id"], threshold=90)
