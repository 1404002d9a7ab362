import math
import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from mailsift.llm import mixing, sharding


def words(n):
    return " ".join(["w"] * n)


def test_key_law_moves_rows_only_into_the_new_shard(documents):
    rows = [(i, words(i % 7), "a") for i in range(3000)]
    found = sharding.assign(documents(rows)).collect()
    assert {r.shard for r in found} == set(range(24))
    moved = [r for r in found if r.shard != r.grown_shard]
    assert moved and all(r.grown_shard == 24 for r in moved)
    for shard in range(24):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    for r in found:
        text = words(r.doc_id % 7).encode()
        assert (r.size, r.text_crc32) == (len(text) + 8, zlib.crc32(text))


def test_weights_change_only_their_subtrees(documents):
    docs = documents([(i, "x", "a") for i in range(4000)])
    place = {s.shard: (s.region, s.rack, s.shard) for s in sharding.tree(24)}
    before = {r.doc_id: place[r.shard] for r in sharding.assign(docs, 24).collect()}
    for weight, grows in ((3.0, True), (0.0, False)):
        weights = [1.0] * 24
        weights[5] = weight
        after = {r.doc_id: place[r.shard] for r in sharding.assign(docs, 24, weights).collect()}
        moved = {i for i in before if before[i] != after[i]}
        for i in moved:
            # Where the way parts first, one of both sides is on the way to shard 5, and it is the one that gains.
            level = next(k for k in range(3) if before[i][k] != after[i][k])
            gains = after[i] if grows else before[i]
            assert gains[: level + 1] == place[5][: level + 1]
        assert moved and (Counter(after.values())[place[5]] > 2 * Counter(before.values())[place[5]]) == grows
        assert grows or place[5] not in after.values()


def plain_place(rows, shards):
    """The shard of each (key, hashes by node), level by level; ``hashes`` are Spark's own."""
    found = {}
    for key, hashes in rows.items():
        nodes = shards
        for level in ("region", "rack", "shard"):
            children = {}
            for s in nodes:
                children.setdefault(getattr(s, level), []).append(s)
            clocks = {}
            for name, below in children.items():
                weight = sum(s.weight for s in below)
                node = (level, below[0].region, name) if level == "rack" else (level, name)
                if weight > 0:
                    clocks[name] = -math.log((((hashes[node] & (2**64 - 1)) >> 11) + 0.5) / 2**53) / weight
            nodes = children[min(clocks, key=clocks.get)]
        found[key] = nodes[0].shard
    return found


def test_draws_level_by_level_and_another_shape(spark, documents):
    docs = documents([(i, "x", "a") for i in range(1500)] + [(None, "x", "a")])
    seen = []
    for n, per_rack, racks in ((24, 4, 3), (25, 4, 3), (24, 5, 2), (7, 2, 1)):
        weights = [1.0 + (s % 3) for s in range(n)]
        weights[n // 2] = 0.0
        shards = sharding.tree(n, weights, per_rack, racks)
        nodes = {("shard", s.shard) for s in shards} | {("rack", s.region, s.rack) for s in shards}
        nodes = sorted(nodes | {("region", s.region) for s in shards}, key=str)
        columns = [F.xxhash64("doc_id", *map(F.lit, node)).alias(f"h{i}") for i, node in enumerate(nodes)]
        hashes = {r[0]: dict(zip(nodes, r[1:])) for r in docs.select("doc_id", *columns).collect()}
        found = {r.doc_id: r.shard for r in sharding.assign(docs, n, weights, per_rack, racks).collect()}
        assert found == plain_place(hashes, shards)
        seen.append(found)
    assert seen[0] != seen[2]


def test_shares_follow_weights(documents):
    docs = documents([(i, "", "a") for i in range(20_000)])
    found = Counter(r.shard for r in sharding.assign(docs).collect())
    assert all(abs(found[s] - 20_000 / 24) < 5 * (20_000 / 24) ** 0.5 for s in range(24))


def test_many_shards_cost_levels_times_fan_out(documents):
    docs = documents([(i, "", "a") for i in range(2_000)])
    found = sharding.assign(docs, 4_000, per_rack=20, racks=20).collect()
    assert len({r.shard for r in found}) > 1_200
    assert all(r.grown_shard in (r.shard, 4_000) for r in found)


def test_sharding_of_odd_rows(documents):
    rows = [(None, None, None), (None, "x", "a"), (7, "", "a"), (7, "", "a"), (7, "y" * 500_000, "a")]
    found = sharding.assign(documents(rows, shard="s", slot="t", size="u", _bucket="b", _group="g")).collect()
    assert len(found) == 5
    assert len({r.shard for r in found if r.doc_id == 7}) == 1
    assert sorted(r.size for r in found) == [8, 8, 8, 9, 500_008]
    assert sharding.assign(documents([])).collect() == []


def expected_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2.0 * sizes[s] for s in full)
        open_ -= full
    return target


def test_mix_meets_its_targets(documents):
    rng = random.Random(3)
    sources = ["b", "é", "a", None, "z", "c", "hot"]
    rows = [(i, words(rng.randint(0, 60)), "hot" if i % 3 == 0 else rng.choice(sources)) for i in range(1500)]
    docs = documents(rows)
    found = {r.doc_id: r for r in mixing.mix(docs).collect()}
    sizes = Counter()
    for i, t, s in rows:
        sizes[s] += len(t.split())
    target = expected_targets(sizes)
    taken = Counter()
    for i, t, s in rows:
        r = found[i]
        assert (r.size, r.source_size) == (len(t.split()), sizes[s])
        assert abs(r.target - target[s]) < 1e-6 * target[s]
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2 and 0 <= r.rate <= 2
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 60 for s in sizes)
    again = {r.doc_id: r for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == found
    copies = Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    assert copies == Counter({i: r.copies for i, r in found.items() if r.copies})


def test_mix_rates_are_exponentially_tilted(documents):
    rows = [(i, words(1 + i % 9), "ab"[i % 2]) for i in range(400)]
    found = mixing.mix(documents(rows)).collect()
    for source in range(2):
        slope = {
            round(math.log(r.rate / (2 - r.rate)) / r.size, 9)
            for r in found if r.doc_id % 2 == source and 0 < r.rate < 2
        }
        assert len(slope) <= 1


def test_mix_of_odd_rows(documents):
    rows = [(1, None, None), (2, "", None), (3, "a b", "s"), (3, "a b", "s"), (None, "c", "s"), (4, "", "zero")]
    found = mixing.mix(documents(rows, size="x", rate="y", target="z", _rank="r")).collect()
    assert len(found) == 6
    assert all(r.target == 0 and r.taken == 0 for r in found if r.source_size == 0)
    assert mixing.mix(documents([])).collect() == []
    mixed = mixing.mixed_documents(documents(rows, size="x", rate="y"))
    assert mixed.columns[-2:] == ["size", "rate"]
