import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from mailsift.llm import ctw


def held_out(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + ["\n"]


def plain_model(streams, depth):
    """Context-tree weighting of the counts of ``streams``, node by node; the path ends at the deepest
    seen node."""
    counts = Counter()
    for s in streams:
        data = b"\n" * depth + s
        for i in range(depth, len(data)):
            for d in range(depth + 1):
                for b in range(8):
                    node = (data[i - d : i], data[i] >> (8 - b) | 1 << b)
                    counts[node, data[i] >> (7 - b) & 1] += 1
    nodes = {n for n, _ in counts}

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    children = {}
    for context, node in nodes:
        if context:
            children.setdefault((context[1:], node), []).append((context, node))
    weight, own = {}, {}
    for n in sorted(nodes, key=lambda n: -len(n[0])):
        e = log_kt(counts[n, 0], counts[n, 1])
        if len(n[0]) == depth:
            weight[n], own[n] = e, 1.0
        else:
            below = sum(weight[c] for c in children[n])
            weight[n] = np.logaddexp(math.log(0.5) + e, math.log(0.5) + below)
            own[n] = math.exp(math.log(0.5) + e - weight[n])

    def log10_probability(s):
        data, total = b"\n" * depth + s, 0.0
        for i in range(depth, len(data)):
            for b in range(8):
                path = []
                for d in range(depth + 1):
                    n = (data[i - d : i], data[i] >> (8 - b) | 1 << b)
                    if n not in nodes:
                        break
                    path.append(n)
                chance, left = (0.0, 1.0) if path else (0.5, 0.0)
                for k, n in enumerate(path):
                    kt = (counts[n, 1] + 0.5) / (counts[n, 0] + counts[n, 1] + 1)
                    part = 1.0 if k == len(path) - 1 else own[n]
                    chance += left * part * kt
                    left *= 1 - part
                total += math.log10(chance if data[i] >> (7 - b) & 1 else 1 - chance)
        return total

    return log10_probability


@pytest.mark.parametrize("blocks", [False, True])
def test_scores_equal_a_plain_tree(documents, by_id, monkeypatch, blocks):
    monkeypatch.setattr(ctw, "COMMON_TOKENS", 16)
    if blocks:
        monkeypatch.setattr(ctw, "BLOCK_NODES", 2_500)
    rng = random.Random(6)
    word = lambda: rng.choice(["ab", "Abba", "bé", "c", "cab", "xyz"]) + rng.choice(["", "a", "q"])
    texts = [" \t".join(word() for _ in range(rng.randint(0, 30))) for _ in range(40)] + ["", None, "ÿ\x1c only here"]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    found = by_id(ctw.score(documents(rows, data="x", row="y", score="z")))
    train = [t for i, t, _ in rows if not held_out(i)]
    stream = lambda t: "".join(w + " " for w in tokens(t)[:-1]).encode() + b"\n"
    model = plain_model([stream(t) for t in train], ctw.DEPTH)
    counted = Counter(w for t in train for w in tokens(t))
    n, v = sum(counted.values()), len(counted)
    for i, t, _ in rows:
        r = found[i]
        assert r.held_out == held_out(i)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens(t)), sum(counted[w] > 0 for w in tokens(t)), n)
        assert r.base_score == pytest.approx(sum(math.log10((counted[w] + 1) / (n + v + 1)) for w in tokens(t)))
        assert r.score == pytest.approx(model(stream(t)), rel=1e-4, abs=1e-3)


def test_a_byte_s_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    stream = bytes(rng.choice(list(b"abcab "), 400).tolist()) + b"\n"
    pieces = [s for s, _ in ctw._pieces([stream])]
    keys, n = np.unique(np.concatenate(pieces), return_counts=True)
    levels = ctw.subtrees(keys, n, 0)
    levels[0].descend(np.zeros(len(levels[0].key)), np.ones(len(levels[0].key)))
    for d in range(1, ctw.DEPTH + 1):
        parent = np.searchsorted(levels[d - 1].key, levels[d].parents())
        a, b = levels[d - 1].handed_down()
        levels[d].descend(a[parent], b[parent])
    nodes = np.concatenate([ctw.node_key(d, level.key) for d, level in sorted(levels.items())])
    bits = np.concatenate([level.bit for _, level in sorted(levels.items())])
    block = ctw.Block(0, 1, keys, ctw._string_logs(keys, levels[ctw.DEPTH]), nodes, bits)
    for context in (keys[0] >> 8, keys[-1] >> 8, 0x6162636162, 0x0102030405):
        strings = (np.int64(context) << 8) | np.arange(256)
        assert np.exp(block.logs(strings)).sum() == pytest.approx(1.0, abs=1e-4)


def test_odd_rows(documents):
    assert ctw.score(documents([])).collect() == []
    only = ctw.score(documents([(next(i for i in range(99) if held_out(i)), "ab", "s")])).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in only] == [(0, 0, 0.0)]
    assert only[0].score == pytest.approx(-4 * 8 * math.log10(2))
    rows = [(None, "a b", "s"), (1, "a b", "s"), (1, "a b", "s")]
    found = ctw.score(documents(rows)).collect()
    assert len(found) == 3 and len({r.score for r in found}) == 1
