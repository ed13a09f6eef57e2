"""Pieces that are used again and again are encoded once, though the memory of pieces is bounded."""

import public_tokenizers
import pytest

from touchline.llm import tokens


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_in_use_are_not_learnt_again(monkeypatch, name):
    monkeypatch.setattr(tokens, "REMEMBERED", 40)
    made = tokens.Encoder(public_tokenizers.path(name), 0)
    learnt, learn = [], made._learn
    monkeypatch.setattr(made, "_learn", lambda words: (learnt.extend(words), learn(words)))
    usual = [f"usual{i}é" for i in range(20)]
    for turn in range(30):
        text = " ".join(["start", *usual, *(f"rare{turn}x{i}" for i in range(9))])
        (raw,) = made.many([text])
        ids = made.tokenizer.encode(text, add_special_tokens=False).ids
        assert raw == tokens._packed([*ids, 0])
        assert len(made.known) + len(made.older) <= 2 * (tokens.REMEMBERED + 29)
    assert len(learnt) == 20 + 30 * 9
