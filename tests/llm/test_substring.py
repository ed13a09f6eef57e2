import hashlib
import re

from touchline.llm import substring


def brute(rows, k=20):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    seen, out = set(), []
    for i, w in sorted(words, key=lambda x: x[0]):
        gone = set()
        for s in range(len(w) - k + 1):
            key = tuple(w[s : s + k])
            if key in seen:
                gone.update(range(s, s + k))
            seen.add(key)
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_agrees_with_brute_force(docs, corpus):
    rows = [(i, t) for i, t, _ in corpus]
    periodic = [(5001, "a b c " * 40), (5002, "x " + "a b c " * 12), (5003, " ".join(map(str, range(19))))]
    periodic += [(5004, " ".join(map(str, range(20)))), (5005, "q " + " ".join(map(str, range(20))) + " z")]
    got = substring.remove_repeats(docs(rows + periodic), with_text=True).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows + periodic)
    for r in got:
        assert sum(r.spans[1::2]) - sum(r.spans[::2]) == r.n_removed
        if r.n_removed:
            assert hashlib.sha256(bytes(r.kept_text)).hexdigest() == r.kept_sha256


def test_null_repeated_ids_and_empty(docs):
    text = " ".join(f"w{i}" for i in range(25))
    got = substring.remove_repeats(docs([(3, text), (None, text), (3, text), (4, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (3, 25), (3, 25), (4, 0)]
    assert substring.remove_repeats(docs([])).count() == 0
