import random
import re

import pytest
import xxhash

from mailsift.llm import simhash
from mailsift.llm.components import components


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints):
    ids = list(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("paired", [32, 1])
def test_near_duplicates_equal_brute_force(documents, by_id, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng = random.Random(5)
    vocabulary = [f"wort{i}é" for i in range(300)]
    texts = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 300]))]
        for _ in range(8):
            near = list(base)
            if rng.random() < 0.7:
                near[rng.randrange(len(near))] = "Other"
            texts.append("\t ".join(near))
    texts += ["", None, "  \n", "one", "One two", "A\x0bB\x1cC d e", "x " * 30_000]
    rows = [(1000 - i, t, "s") for i, t in enumerate(texts)]
    found = by_id(simhash.near_duplicates(documents(rows, fp="a", key="b", component_id="c")))
    prints = {i: plain_fingerprint(t) for i, t, _ in rows}
    assert {i: int(r.fingerprint, 16) for i, r in found.items()} == prints
    assert {i: r.component_id for i, r in found.items()} == plain_components(prints)
    kept = simhash.one_of_each(documents(rows, fp="a", _id="b"))
    assert kept.columns[-2:] == ["fp", "_id"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(plain_components(prints).values()))


def test_chains_of_fingerprints_are_one_component(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRED", 2)
    chain, value = [], 0
    for b in range(0, 60, 2):
        value |= 3 << b
        chain.append(value)
    rows = [(v,) for v in chain] + [(-1,)]
    links = simhash.links(spark.createDataFrame(rows, "fp long")).collect()
    assert all((r.a ^ r.b).bit_count() <= 2 for r in links)
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.component_id for r in found} == {min(chain)} and len(found) == len(chain)


def test_odd_rows(documents):
    assert simhash.near_duplicates(documents([])).collect() == []
    rows = [(None, "a b c d", "s"), (3, "a b c d", "s"), (3, "a b c d", "s"), (2, "q r s t u v w", "s")]
    found = simhash.near_duplicates(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in found) == [(0, 3), (2, 2), (3, 3), (3, 3)]
    assert sorted(r.doc_id for r in simhash.one_of_each(documents(rows)).collect()) == [2, 3]


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    found = {r.node: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(201)) and all(found[i] == 1000 for i in range(1000, 1200))
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_null_and_repeated_ids_keep_one_row_of_each_component(documents):
    rows = [(None, "a b c d", "s"), (None, "q r s t u v w", "s"), (None, "q r s t u v w", "s"), (3, "one two three", "s"),
            (3, "four five six", "s"), (1, "four five six", "s")]
    kept = sorted((r.doc_id or 0, r.text) for r in simhash.one_of_each(documents(rows)).collect())
    assert kept == [(0, "a b c d"), (0, "q r s t u v w"), (1, "four five six"), (3, "one two three")]
