import hashlib
import random

import numpy as np
import pytest

from mailsift.llm import suffix_array, suffix_dedup


@pytest.mark.parametrize("buckets", [512, 2])
def test_suffix_array_and_common_prefixes(monkeypatch, buckets):
    monkeypatch.setattr(suffix_array, "BUCKETS", buckets)
    rng = np.random.default_rng(1)
    for _ in range(60):
        texts = [rng.integers(2, 2 + rng.integers(1, 4), rng.integers(1, 60)) for _ in range(rng.integers(1, 6))]
        s = np.concatenate([np.append(t, 1) for t in texts] + [[0]]).astype(np.int64)
        left = np.concatenate([np.arange(len(t), -1, -1) for t in texts] + [[0]])
        order = suffix_array.suffix_array(s)
        assert list(order) == sorted(range(len(s)), key=lambda i: list(s[i:]))
        before, common = suffix_array.permuted_common_prefixes(s, order, left)
        for a, b in zip(order, order[1:]):
            n, most = 0, min(left[a], left[b])
            while n < most and s[a + n] == s[b + n]:
                n += 1
            assert (before[b], common[b]) == (a, n)


def brute(texts, length):
    seen = {}
    for t in texts:
        for k in range(len(t) - length + 1):
            seen[t[k : k + length]] = seen.get(t[k : k + length], 0) + 1
    out = []
    for t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept if sum(gone) else None))
    return out


@pytest.mark.parametrize("hot", [2048, 2])
def test_equals_brute_force(documents, by_id, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_STRETCHES", hot)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5)))
    make = lambda n: " ".join(word() for _ in range(n))
    passage, base = make(40), make(300)
    texts = [make(30) + passage + make(rng.randint(1, 40)) for _ in range(40)]
    texts += [base.replace("a", "b", k) for k in range(12)] + [base] * 5
    texts += ["abc " * 300, "z" * 900, passage[:150], passage + passage, "", None, "ab " * 20_000]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    found = by_id(suffix_dedup.remove_repeats(documents(rows, kept="k", ranges="r", anchor="a")))
    expected = brute([(t or "").encode() for t in texts], 200)
    for i, e in enumerate(expected):
        r = found[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == e[:4], i
        assert (None if r.kept is None else bytes(r.kept)) == e[4]


def test_exactly_200_bytes_and_odd_rows(documents):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh") for _ in range(200))
    rows = [(1, "x" + text, "s"), (2, text + "y", "s"), (3, text[:199], "s"), (None, None, None), (4, "q", "s"), (4, "q", "s")]
    found = {(r.doc_id, r.n_bytes): r for r in suffix_dedup.remove_repeats(documents(rows)).collect()}
    assert [found[1, 201].n_removed, found[2, 201].n_removed, found[3, 199].n_removed] == [200, 200, 0]
    assert found[None, 0].kept_sha256 == hashlib.sha256(b"").hexdigest()
    repeated = [(5, text * 2, "s")] * 2
    again = suffix_dedup.remove_repeats(documents(repeated)).collect()
    assert [(r.n_removed, r.n_spans) for r in again] == [(400, 1)] * 2
    assert suffix_dedup.remove_repeats(documents([])).collect() == []
