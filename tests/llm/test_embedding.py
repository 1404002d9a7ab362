import numpy as np
import pytest

from mailsift.llm import embedding

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, part string, block string"


def brute(rows):
    good = {}
    for i, v, label, *_ in rows:
        if v is not None and label is not None and None not in v:
            a = np.array(v, np.float32).astype(float)
            if np.isfinite(a).all() and a.any():
                good[i] = (a / np.linalg.norm(a), label)
    links = {i: [] for i, *_ in rows}
    for a, (u, p) in good.items():
        for b, (v, q) in good.items():
            if a != b and p == q and len(u) == len(v) and u @ v >= 0.93:
                links[a].append(b)
    component = {}
    for i in sorted(links):
        if i not in component:
            todo = [i]
            while todo:
                j = todo.pop()
                if j not in component:
                    component[j] = i
                    todo += links[j]
    return {i: (len(links[i]), component[i]) for i in links}


@pytest.mark.parametrize("block_rows", [1024, 16])
def test_equals_brute_force(spark, by_id, monkeypatch, block_rows):
    monkeypatch.setattr(embedding, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(8)
    rows = []
    for c in range(30):
        centre = rng.normal(size=12)
        for _ in range(rng.integers(1, 12)):
            v = centre + rng.normal(size=12) * rng.choice([0.0, 0.05, 0.25])
            rows.append((len(rows) * 7 % 1009, [float(np.float32(x)) for x in v], int(rng.integers(0, 2))))
    rows += [
        (2000, None, 1), (2001, [0.0] * 12, 1), (2002, [float("nan")] * 12, 0), (2003, [None] * 12, 0),
        (2004, [1.0] * 12, None), (2005, [float("inf")] + [0.0] * 11, 1), (2006, [1.0, 0.0], 1),
        (2007, [2.0, 0.0], 1), (2008, [], 1), (2009, [1e30] * 12, 1), (2010, [1e-30] * 12, 1),
    ]
    df = spark.createDataFrame([r + ("x", "y", "z") for r in rows], SCHEMA)
    found = by_id(embedding.near_duplicates(df), "vec_id")
    assert {i: (r.n_links, r.component_id) for i, r in found.items()} == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, [1.0, 0.0], 1, "", "", "")] * 3 + [(None, [1.0, 0.0], 1, "", "", "")]
    found = embedding.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.n_links, r.component_id) for r in found] == [(3, 1)] * 4
    assert embedding.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_overlong_vector(spark, by_id):
    """A stray vector of another length costs what it holds; those of its length are compared on all of it."""
    rng = np.random.default_rng(3)
    long = [0.0] * 2_000 + [float(x) for x in rng.integers(1, 9, 98_000)]
    other = list(long)
    other[:2_000] = [9.0] * 2_000
    rows = [(i, [float(x) for x in rng.integers(1, 5, 4)], 1, "", "", "") for i in range(60)]
    rows += [(100, long, 1, "", "", ""), (101, other, 1, "", "", "")]
    found = by_id(embedding.near_duplicates(spark.createDataFrame(rows, SCHEMA)), "vec_id")
    assert {i: (r.n_links, r.component_id) for i, r in found.items()} == brute(rows)
    assert found[101].component_id == 100


def test_distant_blocks_are_skipped(spark, monkeypatch):
    rng = np.random.default_rng(1)
    boxes, blocks = [], 64
    for b in range(blocks):
        at = [float(x) for x in rng.normal(b, 0.01, 2)]
        boxes.append((b // blocks, b, "p", *at, *at))
    df = spark.createDataFrame(
        [(p, b, *rest) for _, b, p, *rest in boxes], "part string, block long, lo0 double, lo1 double, hi0 double, hi1 double"
    )
    pairs = {(r.a, r.b) for r in embedding.close_pairs(df, 2, 2.0).collect()}
    assert {(b, b) for b in range(blocks)} <= pairs and {(b, b + 1) for b in range(blocks - 1)} <= pairs
    assert len(pairs) < 4 * blocks
