"""Tables that hold texts again while near copies are looked for are written compactly."""

import glob

from touchline import session
from touchline.llm import jaccard


def test_scratch_tables_of_near_dedup_use_zstd(spark, docs, monkeypatch):
    names, plain = [], session.Scratch.write

    def write(self, df, name):
        out = plain(self, df, name)
        names.extend(glob.glob(self.path(name).removeprefix("file:") + "/*.parquet"))
        return out

    monkeypatch.setattr(session.Scratch, "write", write)
    text = "one two three four five six seven eight nine ten"
    jaccard.link(docs([(1, text, "a"), (2, text + " eleven", "b"), (3, "x", "c")]))
    assert names and all(n.endswith(".zstd.parquet") for n in names)
