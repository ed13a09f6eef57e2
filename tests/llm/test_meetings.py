"""Near copies of different components meet about once, however many tokens they share."""

import random

from touchline import session
from touchline.llm import jaccard


def test_pairs_meet_once_and_none_is_lost(spark, docs, monkeypatch):
    rng = random.Random(8)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(400), 5):
            words[k] = f"u{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    tables, plain = {}, session.Scratch.write

    def write(self, df, name):
        out = plain(self, df, name)
        if name in ("open", "again"):
            tables[name] = out.collect()
        return out

    monkeypatch.setattr(session.Scratch, "write", write)
    jaccard.link(docs(rows))
    met = jaccard._meetings(spark.createDataFrame(tables["open"])).collect()
    pairs = {(r.a, r.b) for r in met}
    assert pairs == {(r.a, r.b) for r in tables["again"]}
    assert len(pairs) > 200 and len(met) < 3 * len(pairs)
    # Without the lists of least tokens the same pairs meet, at every token they share.
    loose = spark.createDataFrame([{**r.asDict(), "least": [2**62 + 2 * i]} for i, r in enumerate(tables["open"])])
    every = jaccard._meetings(loose).collect()
    assert {(r.a, r.b) for r in every} == pairs and len(every) > 20 * len(pairs)
