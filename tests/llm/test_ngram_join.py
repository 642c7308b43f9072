import random
import re
from collections import defaultdict

import numpy as np
import pytest

from popcorr.llm import ngram_join
from popcorr.llm.graph import components


def shingles(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    key = lambda v: (v is None, v or 0)
    return sorted((key(d), len(sets[i]), key(min(least[find(i)], default=None) if sets[i] else d)) for i, (d, _) in enumerate(rows))


def found(docs):
    key = lambda v: (v is None, v or 0)
    return sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in ngram_join.classes(docs).collect())


def copies(seed, groups=12, each=12):
    """Near copies around the threshold, chains of edits, and passages that many documents share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    passages = [[word() for _ in range(rng.randint(10, 40))] for _ in range(3)]
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(8, 90))]
        if rng.random() < 0.6:
            base += rng.choice(passages)
        now = base
        for _ in range(each):
            now = list(rng.choice([base, now]))
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(now))
                now[k:k + rng.randint(0, 2)] = [word() for _ in range(rng.randint(0, 2))]
            rows.append((len(rows) * 3, " ".join(now)))
    rng.shuffle(rows)
    return rows


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAST_BUCKETS", 4)


def test_edge_rows(edge, edge_list):
    assert found(edge) == brute([(d, t) for d, t, _, _ in edge_list])


def test_near_copies(spark):
    rows = copies(1)
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_frequent_classes_lose_no_link(spark, monkeypatch):
    # nearly every shingle that repeats is frequent, so links are found by combinations
    monkeypatch.setattr(ngram_join, "FREQUENT", 2)
    for size, large, seed in ((16, 32, 2), (4, 3, 3)):
        monkeypatch.setattr(ngram_join, "CLASS_SIZE", size)
        monkeypatch.setattr(ngram_join, "LARGE", large)
        rows = copies(seed)
        assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)) == brute(rows)


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(3, 120))
        x = rng.integers(1, 2**63, n, dtype=np.uint64)
        y = np.concatenate((x[int(n * 0.12):], rng.integers(1, 2**63, int(n * 0.1), dtype=np.uint64)))
        x, y = np.unique(x), np.unique(y)
        common = np.intersect1d(x, y)
        if 100 * len(common) < 75 * (len(x) + len(y) - len(common)):
            continue
        # some of the shingles that one of the two has alone are in third sets
        both = np.unique(np.concatenate((x, y)))
        known = np.union1d(common, rng.choice(both, int(rng.integers(0, len(both) + 1)), replace=False))
        frequent = np.unique(rng.choice(known, int(rng.integers(0, len(known) + 1)), replace=False))
        found = []
        for s in (x, y):
            own = s[np.isin(s, known)]
            often = np.isin(own, frequent)
            code = np.concatenate((own[~often], own[often]))
            sig, _ = ngram_join.signatures(np.array([len(s)]), np.array([len(s) - len(own)]), np.array([0, len(own)]), code, np.sort(often))
            found.append(sig)
        assert np.intersect1d(*found).size


def test_every_shared_shingle_is_found_once_by_class(spark, monkeypatch):
    """The classes of all shingles equal a count over all sets, whatever tasks met them, copies included."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 4)
    rows = copies(9, 10, 14)
    rows += [(1000 + i, t) for i, (_, t) in enumerate(rows[:60])]
    for tasks in (1, 7):
        docs = spark.createDataFrame(rows, "id long, text string").repartition(tasks)
        bits = 6
        got = {}
        for r in ngram_join.shared(ngram_join.occurrences(docs, bits), bits).collect():
            for side, often in ((r.rare, False), (r.often, True)):
                for c in np.frombuffer(side, np.uint64).tolist():
                    got[r.ref, c] = often
        sets = {}
        for _, t in rows:
            data = np.frombuffer(t.encode(), np.uint8)
            doc, value = ngram_join.T.shingles(data, np.array([0, len(data)]), 5)
            n, ref, _ = ngram_join.set_keys(value, doc, 1)
            sets[int(ref[0])] = set((value >> np.uint64(32 - bits)).tolist())
        count = defaultdict(int)
        for s in sets.values():
            for c in s:
                count[c] += 1
        assert {k for k in got} == {(r, c) for r, s in sets.items() for c in s if count[c] > 1}
        wrong = [(c, often, count[c]) for (_, c), often in got.items() if often != (count[c] >= 4)]
        assert not [x for x in wrong if not x[1]]                    # a class may only be too high, for all sets alike
        assert all(len({o for (_, c), o in got.items() if c == x}) == 1 for x, _, _ in wrong)


def test_pairs_left_open_by_hub_bitmaps_are_few_and_lose_no_link(spark, monkeypatch):
    """A large group around one text: what is tested pair by pair holds every link between components, and little else."""
    monkeypatch.setattr(ngram_join, "LARGE", 8)
    rng = random.Random(17)
    base = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(150)]
    rows = []
    for i in range(160):
        now = list(base)
        for k in rng.sample(range(150), 1 + i % 11):
            now[k] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(now)))
    made = []
    monkeypatch.setattr(ngram_join, "open_pairs", lambda *a, f=ngram_join.open_pairs: made.append(f(*a).cache()) or made[-1])
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)
    assert sum(m.count() for m in made) < 400                                   # of 12,720 pairs


def test_null_ids_link_like_others(spark):
    rng = random.Random(21)
    base = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    edit = lambda words, *at: [f"edit{i}" if i in at else w for i, w in enumerate(words)]
    bridge = edit(base, 10)
    rows = [(1, " ".join(base)), (None, " ".join(edit(base, 50))), (7, "x y z"), (None, "x y z"), (None, None),
            (2, " ".join(edit(bridge, 30))), (None, " ".join(bridge)), (3, " ".join(edit(base, 10, 55))), (None, " ".join(edit(base, 5, 25, 45)))]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)


def test_blocks_and_stars_change_nothing(spark, monkeypatch):
    rows = copies(31, 8, 20)
    for name, value in (("BLOCK", 3), ("LARGE", 4), ("OPEN_PAIRS", 0)):
        monkeypatch.setattr(ngram_join, name, value)
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)


def test_overlap_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(7)
    for _ in range(300):
        pool = rng.integers(0, 2**64, int(rng.integers(1, 80)), dtype=np.uint64) >> np.uint64(rng.integers(0, 30))
        x, y = (np.unique(rng.choice(pool, int(rng.integers(1, len(pool) + 1)))) for _ in range(2))
        heads = [(s[:len(s) // ngram_join.PREFIX_PART + 1] >> np.uint64(32)).astype("<u4") for s in (x, y)]
        assert ngram_join.overlap_bound(heads[0], len(x), heads[1], len(y)) >= len(np.intersect1d(x, y))


def test_one_large_group_of_near_copies(spark, monkeypatch):
    # copies of one text with few to many edits: some link to most others, some to none
    monkeypatch.setattr(ngram_join, "LARGE", 8)
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(150)]
    rows = []
    for i in range(150):
        now = list(base)
        for _ in range(rng.randint(0, 8)):
            now[rng.randrange(150)] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(now)))
    rows += [(200 + i, t) for i, (_, t) in enumerate(copies(12, 4, 10))]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_sets_by_a_join_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    rows = copies(5)
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_empty_table(empty):
    assert ngram_join.classes(empty).count() == 0
