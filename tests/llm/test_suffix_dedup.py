import hashlib

from touchline.llm import suffix_dedup


def brute(rows, k=100):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda x: x[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - k + 1):
            if b[s : s + k] in seen:
                gone[s : s + k] = b"\1" * k
            seen.add(b[s : s + k])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for j, g in enumerate(gone) if g and not (j and gone[j - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_agrees_with_brute_force(docs, corpus):
    rows = [(i, t) for i, t, _ in corpus]
    periodic = [(5001, "ab" * 300), (5002, "x" + "ab" * 90), (5003, "z" * 99), (5004, "z" * 100), (5005, "z" * 101)]
    base = "".join(chr(97 + i * i % 23) + str(i) for i in range(120))
    edits = [(6000 + i, base[: 20 * i] + "#" * (i % 3 + 1) + base[20 * i :]) for i in range(12)]
    edits += [(7000 + i, str(i) * 9 + base[50:170] + chr(98 + i) * 7) for i in range(20)]
    got = suffix_dedup.remove_repeats(docs(rows + periodic + edits), with_text=True).collect()
    want = brute(rows + periodic + edits)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    for r in got:
        if r.n_removed:
            assert hashlib.sha256(bytes(r.kept_text)).hexdigest() == r.kept_sha256


def test_null_repeated_ids_and_empty(docs):
    text = "".join(f"w{i}" for i in range(60))
    n = len(text)
    got = suffix_dedup.remove_repeats(docs([(3, text), (None, text), (3, text), (4, None), (5, "")])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (3, n), (3, n), (4, 0), (5, 0)]
    assert suffix_dedup.remove_repeats(docs([])).count() == 0
