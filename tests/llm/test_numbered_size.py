"""The numbered copy of the input, which stays while a result is read, is written compactly."""

from touchline.llm.text import numbered


def test_numbered_copies_use_zstd(docs):
    made, number = numbered(docs([(1, "one two", "a"), (2, None, "b")]))
    assert made.inputFiles() and all(n.endswith(".zstd.parquet") for n in made.inputFiles())
    assert sorted(made.drop(number).collect()) == sorted(docs([(1, "one two", "a"), (2, None, "b")]).collect())
