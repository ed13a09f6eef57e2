"""Pieces that come back after some hundred thousand others are not learnt again."""

import public_tokenizers

from touchline.llm import tokens


def test_pieces_outlast_a_task_of_rare_ones(monkeypatch):
    made = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 0)
    usual, learnt, learn = " ".join(f"usual{i}" for i in range(50)), [0], made._learn
    monkeypatch.setattr(made, "_learn", lambda words: (learnt.__setitem__(0, learnt[0] + len(words)), learn(words)))
    (first,) = made.many([usual])
    for turn in range(90):
        made.many([" ".join(["start", *(f"r{turn}x{i}" for i in range(5000))])])
    before = learnt[0]
    assert made.many([usual]) == [first] and learnt[0] == before == 49 + 90 * 5000
