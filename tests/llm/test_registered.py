"""The registered queries and the pipeline, run as the driver runs them, against plain Python."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_jaccard import brute as near
from test_substring import brute as repeated_words
from test_suffix_dedup import brute as repeated_bytes
from touchline.llm import mixing, quality
from touchline.llm.queries import QUERIES

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark, tmp_path, corpus):
    """The corpus, and texts that the quality rules keep, with copies and near copies."""
    rng = random.Random(11)
    words = ["the", "and", "of", "to", "in"] + ["".join(rng.choices("abdeilnorst", k=rng.randint(3, 9))) for _ in range(400)]
    rows = [tuple(r) for r in corpus]
    for i in range(60):
        text = ""
        for _ in range(rng.randint(8, 20)):
            text += " ".join(rng.choices(words, k=rng.randint(6, 14))).capitalize() + ".\n"
        rows.append((10_000 + 10 * i, text, rng.choice(["a", "b"])))
        if i % 4 == 0:
            rows.append((10_001 + 10 * i, text, "c"))
        if i % 5 == 0:
            rows.append((10_002 + 10 * i, text + "Tail of it.\n", "b"))
    full = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    spark.createDataFrame(full, SHAPE).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path), rows


def collected(frame, *names):
    return sorted(tuple(r[n] for n in names) for r in frame.collect())


def test_op3(spark, table):
    folder, rows = table
    got = QUERIES["op3_substring_dedup"](spark, folder)
    assert collected(got, "doc_id", "n_words", "n_removed", "kept_sha256") == repeated_words([r[:2] for r in rows])


def test_op4(spark, table):
    folder, rows = table
    got = QUERIES["op4_ngram_jaccard"](spark, folder)
    assert collected(got, "doc_id", "n_shingles", "component_id") == sorted(near([r[:2] for r in rows]))


def test_op9(spark, table):
    folder, rows = table
    got = QUERIES["op9_suffix_dedup"](spark, folder)
    want = repeated_bytes([r[:2] for r in rows])
    assert collected(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def pieces_make_up(pieces, texts):
    """The packed pieces of each document are its copies' ids, each once, and sequences are gapless."""
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {i: encoder.encode(t or "", add_special_tokens=False).ids + [1] for i, t in texts.items()}
    times, room = Counter(), {}
    for p in pieces:
        ids = tokens[p.doc_id][p.start : p.start + p.length]
        assert len(ids) == p.length
        assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)) == p.ids_crc32
        for k in range(p.start, p.start + p.length):
            times[p.doc_id, k] += 1
        room.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for held in room.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    counts = {i: {times[i, k] for k in range(len(t))} for i, t in tokens.items()}
    assert all(len(c) == 1 for c in counts.values())
    return {i: c.pop() for i, c in counts.items()}


def test_pipeline(spark, table):
    folder, rows = table
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    assert 60 <= len(kept) < len(rows)
    by_id = {i: (t, s) for i, t, s in rows}

    # The stages as listed, each on what the one before wrote, against a plain Python stage.
    want = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/stage-{k}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 4:
            assert docs.columns == columns
            got = sorted(r.doc_id for r in docs.collect())
        if name == "quality rules":
            want = sorted(kept)
        elif name == "exact dedup":
            last = {}
            for i in want:
                last[by_id[i][0] or ""] = max(i, last.get(by_id[i][0] or "", i))
            want = sorted(last.values())
        elif name == "near dedup":
            found = near([(i, by_id[i][0]) for i in want])
            want = sorted(i for i, _, c in found if i == c)
        elif name == "source mix":
            mixed = mixing.mix(spark.read.parquet(f"{folder}/stage-{k - 1}")).collect()
            assert all(r.taken == r.copies * r["size"] for r in mixed)
            want = sorted(i for r in mixed for i in [r.doc_id] * r.copies)
            copies = Counter(want)
        if k < 4:
            assert got == want, name
    assert pieces_make_up(docs.collect(), {i: by_id[i][0] for i in copies}) == copies

    whole = corpus_pipeline.run(spark, folder)
    assert pieces_make_up(whole.collect(), {i: by_id[i][0] for i in copies}) == copies
