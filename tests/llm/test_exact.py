import hashlib
from collections import defaultdict

import pyspark.sql.functions as F
import pytest

from touchline.llm import exact


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max(ids)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("key", [F.xxhash64, lambda c: F.octet_length(c) % 3 + F.lit(0).cast("long")])
def test_agrees_with_grouping_by_text(docs, corpus, key):
    rows = [(i, t) for i, t, _ in corpus]
    got = exact.identify(docs(rows), block=64, key=key).drop("row").collect()
    assert sorted(map(tuple, got)) == expected(rows)


def test_null_and_repeated_ids(docs):
    rows = [(None, "a"), (None, "a"), (4, "a"), (4, "a"), (4, "b"), (None, None), (7, "")]
    got = exact.identify(docs(rows)).collect()
    assert len(got) == 7
    kept = sorted((r.doc_id, r.group_size) for r in got if r.kept)
    assert kept == [(4, 1), (4, 4), (7, 2)]


def test_empty_table(docs):
    assert exact.identify(docs([])).count() == 0
    assert exact.drop_copies(docs([])).count() == 0


def test_drop_copies_keeps_columns(docs):
    frame = docs([(1, "x"), (2, "x"), (3, None)]).withColumn("row", F.lit("mine")).withColumn("key", F.lit(1))
    left = exact.drop_copies(frame)
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 3]
