import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from touchline.llm import tokens

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
HARD = ["", " ", "  a", "a  b", "a \n b", "a\n", "it's I'll 'twas", " a", "a ", "x y z", "ΣΑΣ ς", "é ́e",
        "12 345", "!!! ??", "a\tb c", "<|endoftext|> a", "a<|endoftext|>b c", "\n\n\nx y", "ﬁ İ", "a  b", "\x1c \x1d x"]


@pytest.mark.parametrize("name", FILES)
def test_pieces_are_the_whole(name, corpus):
    path = public_tokenizers.path(name)
    plain, encode = Tokenizer.from_file(path), tokens.Encoder(path, 7)
    all_texts = HARD + [t or "" for _, t, _ in corpus]
    spaced = [" ".join(t.split()) for t in all_texts] + ["a\nb c.\nd", "a\tb c\xa0d e"]
    for some in (all_texts, spaced, spaced[::-1], ["one"], []):
        for text, raw in zip(some, encode.many(some), strict=True):
            got = np.frombuffer(raw, "<u4").tolist()
            assert got == plain.encode(text, add_special_tokens=False).ids + [7], text


def test_round_trip(spark, docs, corpus):
    path = public_tokenizers.path(FILES[0])
    folder = tokens.token_folder(spark)
    rows = [(i, t) for i, t, _ in corpus] + [(None, "null id")]
    manifest = tokens.write_token_files(docs(rows), folder, path, 0)
    got = sorted(map(tuple, tokens.read_token_files(manifest, folder).collect()), key=lambda r: r[1])
    plain, start, want = Tokenizer.from_file(path), 0, []
    for i, t in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_repeated_ids_and_empty_table(spark, docs):
    path, folder = public_tokenizers.path(FILES[0]), tokens.token_folder(spark)
    manifest = tokens.write_token_files(docs([(1, "b"), (1, "a"), (1, "a"), (0, None)]), folder, path, 0)
    got = sorted(tokens.read_token_files(manifest, folder).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start) for r in got] == [(0, 0), (1, 1), (1, 3), (1, 5)]
    folder = tokens.token_folder(spark)
    assert tokens.read_token_files(tokens.write_token_files(docs([]), folder, path, 0), folder).count() == 0
