"""String similarity, 0 to 100, as Column functions.

Levenshtein and all token handling stay in the JVM. Only the LCS (and the combined
score built on it) goes through an Arrow UDF, a whole batch of pairs per call.
"""

from __future__ import annotations

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

from touchline.functions import name_scores

# Ship the scoring code with the query, so executors need no installed package.
cloudpickle.register_pickle_by_value(name_scores)


@F.pandas_udf(T.DoubleType())
def _indel(a: pd.Series, b: pd.Series) -> pd.Series:
    known = a.notna() & b.notna()
    out = pd.Series([None] * len(a), dtype="float64")
    if known.any():
        out[known.values] = name_scores.indel(a[known].tolist(), b[known].tolist())
    return out


@F.pandas_udf(T.DoubleType())
def _combined(a: pd.Series, b: pd.Series, cut: pd.Series) -> pd.Series:
    floor = float(cut.iloc[0]) if len(cut) else 0.0
    return pd.Series(name_scores.combined(a.fillna("").tolist(), b.fillna("").tolist(), floor))


def lev(a: Column, b: Column) -> Column:
    """``100 * (1 - levenshtein / longer length)``."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) * (longest - F.levenshtein(a, b)) / longest
    )


def indel(a: Column, b: Column) -> Column:
    """``100 * 2*LCS / (|a|+|b|)``."""
    return _indel(a, b)


def tokens(name: Column) -> Column:
    """Sorted tokens of a normalised name."""
    return F.array_sort(F.filter(F.split(name, " "), lambda t: t != ""))


def token_sort(a: Column, b: Column) -> Column:
    """Indel ratio of the names with their tokens sorted."""
    return _indel(F.array_join(tokens(a), " "), F.array_join(tokens(b), " "))


def token_set(a: Column, b: Column) -> Column:
    """Token-set ratio; 100 when one name's tokens are all in the other."""
    ta, tb = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    shared = F.length(F.array_join(F.array_intersect(ta, tb), " "))
    da = F.array_join(F.array_except(ta, tb), " ")
    db = F.array_join(F.array_except(tb, ta), " ")
    gap = F.when(shared > 0, 1).otherwise(0)
    la, lb = shared + gap + F.length(da), shared + gap + F.length(db)
    # LCS of the rests, recovered from their ratio, plus the shared part.
    rest = F.round(_indel(da, db) * (F.length(da) + F.length(db)) / F.lit(100.0))
    joint = F.lit(100.0) * (rest + F.lit(2) * (shared + gap)) / (la + lb)
    alone = F.when(
        shared > 0,
        F.greatest(
            F.lit(100.0) * (shared * 2) / (shared + la), F.lit(100.0) * (shared * 2) / (shared + lb)
        ),
    ).otherwise(F.lit(0.0))
    return (
        F.when((F.size(ta) == 0) | (F.size(tb) == 0), F.lit(0.0))
        .when((shared > 0) & ((da == "") | (db == "")), F.lit(100.0))
        .otherwise(F.greatest(joint, alone))
    )


# Not pushed through filters on the score: that would score every pair twice.
_combined_once = _combined.asNondeterministic()


def combined(a: Column, b: Column, cut: float = 0.0) -> Column:
    """The combined score of two normalised names; below ``cut`` only some lower bound of it."""
    return _combined_once(a, b, F.lit(float(cut)))


def rounded(score: Column) -> Column:
    """Score as a whole number, halves to even."""
    return F.bround(score, 0).cast("int")
