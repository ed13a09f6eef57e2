"""Rows keep their numbers when later scans of the input are split otherwise."""

import random

import pytest

from touchline import session
from touchline.llm import exact, jaccard, mixing, quality, substring, suffix_dedup, warc

SPLITS = "spark.sql.files.minPartitionNum"


@pytest.fixture
def resplit(spark, monkeypatch):
    """Each table that is written changes the splits of the scans after it."""
    plain, turn = session.Scratch.write, [0]

    def write(self, df, name):
        out = plain(self, df, name)
        turn[0] += 1
        spark.conf.set(SPLITS, "1" if turn[0] % 2 else "64")
        return out

    def begin():
        turn[0] = 0
        spark.conf.set(SPLITS, "64")
        monkeypatch.setattr(session.Scratch, "write", write)

    yield begin
    spark.conf.unset(SPLITS)


RUNS = {
    "op3": lambda d: substring.remove_repeats(d).drop("row"),
    "op4": lambda d: jaccard.link(d).drop("row"),
    "op9": lambda d: suffix_dedup.remove_repeats(d).drop("row"),
    "quality": quality.keep_good,
    "exact": exact.drop_copies,
    "near": jaccard.drop_near_copies,
    "mix": mixing.take_copies,
}


@pytest.mark.parametrize("name", RUNS)
def test_other_splits_change_nothing(spark, docs, corpus, rows, resplit, name):
    frame = docs(corpus)
    want = rows(RUNS[name](frame))
    resplit()
    made = RUNS[name](frame)
    for splits in ("1", "64"):
        spark.conf.set(SPLITS, splits)
        assert rows(made.select("*")) == want


def test_other_splits_mark_the_same_pages(spark, tmp_path, rows, resplit):
    rng = random.Random(3)
    body = ["".join(rng.choices("abcdef ", k=1500)) for _ in range(8)]
    pages = [(i, rng.choice(body)) for i in range(40)]
    path = str(tmp_path / "pages")
    spark.createDataFrame(pages, "page_id long, html string").repartition(3).write.parquet(path)
    frame = spark.read.parquet(path)

    def read(folder):
        return rows(warc.read_archives(warc.write_archives(frame, folder), folder))

    want = read(f"file://{tmp_path}/before")
    resplit()
    assert read(f"file://{tmp_path}/after") == want
