import random

from hypothesis import given, settings, strategies as st

from touchline.llm import suffixes


@given(st.lists(st.integers(1, 3), max_size=80))
@settings(max_examples=300, deadline=None)
def test_order_of_suffixes(symbols):
    text = symbols + [0]
    want = sorted(range(len(text)), key=lambda i: text[i:])
    order = suffixes.suffix_array(text)
    assert order == want
    common = suffixes.common_prefixes(text, order)
    for i in range(1, len(order)):
        a, b = text[order[i - 1] :], text[order[i] :]
        k = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common[i] == k


def test_repetitive_texts():
    for unit in ("ab", "aab", "a", "abaab"):
        text = [ord(c) for c in unit * 60] + [0]
        assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
    rng = random.Random(1)
    text = [rng.randint(1, 200) for _ in range(3000)] * 2 + [0]
    assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
