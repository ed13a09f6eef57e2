"""Anchors are the least hashes of their windows; the buckets they are dealt to are even all the same."""

import numpy as np

from touchline.llm import suffix_dedup


def test_buckets_of_anchors_are_even():
    data = np.random.default_rng(4).integers(97, 123, 400_000).astype(np.uint8)
    at = np.arange(0, len(data) + 1, 4000)
    h, _, doc, _ = suffix_dedup.byte_anchors(100, data, at)
    n = np.bincount((h >> np.uint64(58)).astype(int), minlength=64)
    assert len(h) > 5000 and n.max() < 2 * n.mean() and n.min() > n.mean() / 2
    again, *_ = suffix_dedup.byte_anchors(100, data[4000:8000], np.array([0, 4000]))
    assert (again == h[doc == 1]).all()
