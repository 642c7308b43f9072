import random
import zlib
from collections import defaultdict

from popcorr.llm import shards


class _Local(shards.Ends):
    def __init__(self, sizes):
        ends, at = [], 0
        for s in sizes:
            at += s
            ends.append(at)
        super().__init__(None, at, ends)
        self.sizes = sizes

    def large(self, capacity):
        return [(e - s, e) for e, s in zip(self.local, self.sizes) if s > capacity]


def _feasible(sizes, capacity, k):
    used, room = 0, 0
    for s in sizes:
        if s > room:
            used, room = used + 1, capacity
        room = room - s if s <= room else 0
    return used <= k


def test_smallest_capacity_against_trying_them_all():
    rng = random.Random(3)
    for _ in range(200):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 40))]
        k = rng.randint(1, 8)
        ends = _Local(sizes)
        want = next(c for c in range(sum(sizes) + 1) if _feasible(sizes, c, k))
        even = -(-sum(sizes) // k)
        got = shards.smallest_capacity(ends, max(sizes), k, sum(s for s in sizes if s > even))
        assert got == want
        cuts = shards.even_cuts(ends, got, k, ends.large(got))
        assert len(cuts) == k and cuts[-1] == ends.total and cuts == sorted(cuts)
        alone = {e: s for s, e in ends.large(got)}
        assert all(b - a <= got or alone.get(b) == a for a, b in zip([0, *cuts], cuts))
        assert all(c == 0 or c in ends.local for c in cuts)


def test_search_by_lookups_is_the_same(spark, monkeypatch):
    rng = random.Random(4)
    sizes = [rng.randint(1, 50) for _ in range(60)] + [900]
    local = _Local(sizes)
    table = spark.createDataFrame(list(zip(local.local, sizes)), "end long, group_bytes long")
    monkeypatch.setattr(shards, "LOCAL_ENDS", 0)
    ends = shards.Ends(table, local.total)
    for limit in (0, 10, 40):
        monkeypatch.setattr(shards, "LOCAL_ENDS", limit)
        capacity = shards.smallest_capacity(ends, 900, 6, 900)
        assert capacity == shards.smallest_capacity(local, 900, 6, 900)
    large = local.large(capacity)
    assert shards.even_cuts(ends, capacity, 6, large) == shards.even_cuts(local, capacity, 6, large)


def test_edge_rows(edge, edge_list):
    rows = shards.shard(edge, 4).collect()
    want = sorted((len((t or "").encode()) + 1, -1 if t is None else zlib.crc32(t.encode())) for _, t, _, _ in edge_list)
    assert sorted((r["size"], -1 if r.text_crc32 is None else r.text_crc32) for r in rows) == want
    slots, by_text = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        by_text[r["size"], r.text_crc32].add(r.shard)
    assert set(slots) <= set(range(4))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in by_text.values())
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, shards.shard(edge, 4).collect()), key=str)


def test_a_hot_group_is_whole_and_the_rest_is_even(spark):
    rows = [(i, "hot " * 20 if i % 3 == 0 else f"text {i} " * 10) for i in range(900)]
    got = shards.shard(spark.createDataFrame(rows, "doc_id long, text string"), 16).toPandas()
    per = got.groupby("shard")["size"].sum()
    assert got[got.doc_id % 3 == 0]["shard"].nunique() == 1
    others = per.drop(got[got.doc_id % 3 == 0]["shard"].iloc[0])
    assert others.max() <= 1.5 * others.min()


def test_empty_table_and_one_row(empty, spark):
    assert shards.shard(empty).count() == 0
    one = shards.shard(spark.createDataFrame([(7, "a")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r["size"], r.slot) for r in one] == [(7, 2, 0)]
