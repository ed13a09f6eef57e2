"""The mix's copies are taken where the rows are read: texts are neither written again nor shuffled."""

from collections import Counter

from touchline.llm import mixing


def test_copies_are_the_mix_and_no_text_is_moved(docs, corpus):
    frame = docs(corpus)
    taken = mixing.take_copies(frame)
    assert set(taken.inputFiles()) == set(frame.inputFiles())
    want = {r.doc_id: r.copies for r in mixing.mix(frame).collect()}
    got = Counter(r.doc_id for r in taken.collect())
    assert got == Counter({d: n for d, n in want.items() if n}) and max(got.values()) > 1
    assert taken.schema == frame.schema
    whole = {r.doc_id: r for r in frame.collect()}
    assert all(r == whole[r.doc_id] for r in taken.collect())


def test_copies_where_columns_have_the_mix_names(docs, corpus):
    frame = docs(corpus)
    named = frame.withColumnRenamed("n_chars", "size").withColumnRenamed("lang", "no")
    assert sorted(map(str, mixing.take_copies(named).collect())) == sorted(
        map(str, mixing.take_copies(frame).withColumnRenamed("n_chars", "size").withColumnRenamed("lang", "no").collect())
    )
