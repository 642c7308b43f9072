import hashlib
import math
import re
from collections import defaultdict

import pytest

from popcorr.llm import mixture


def _targets(sizes):
    """Water filling step by step: share, stop those over their cap, share the excess among the rest."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_edge_rows(edge, edge_list):
    rows = mixture.mix(edge).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, _, s in edge_list:
        sizes[s] += count(t)
    target = _targets(sizes)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r["size"]) for r in rows) == sorted(((d is None, d or 0), count(t)) for d, t, _, _ in edge_list)
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r["size"] * r.copies
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixture.mix(edge.repartition(3)).collect()), key=str)


def test_sources_come_near_their_targets_and_odds_matter(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), "hot" if i % 3 else f"s{i % 7}") for i in range(6000)]
    out = mixture.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    per = out.assign(taken=out["size"] * out["copies"]).groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((per.taken - per.target).abs() <= 2).all()
    assert per.target.sum() == pytest.approx(1.5 * out["size"].sum())
    part = out[(out.source == "hot")]
    base = int(part.target.iloc[0] // part.source_size.iloc[0])
    extra = (part.copies - base).groupby(part["size"] > 25).mean()
    assert extra[True] > extra[False]                          # longer documents have greater odds
    other = mixture.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), seed="other").toPandas()
    assert not out.sort_values("doc_id").copies.reset_index(drop=True).equals(other.sort_values("doc_id").copies.reset_index(drop=True))


def test_texts_without_words(spark):
    rows = mixture.mix(spark.createDataFrame([(1, None, None), (2, "  ", "a")], "doc_id long, text string, source string")).collect()
    assert sorted((r.doc_id, r["size"], r.target, r.copies) for r in rows) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_empty_table(empty):
    assert mixture.mix(empty).count() == 0


def _one_by_one(rows):
    """copies by id: walk each source in rank order, take what fits, then one closing document."""
    by = defaultdict(list)
    for i, n, s in rows:
        by[s].append((i, n))
    target, copies = _targets({s: sum(n for _, n in d) for s, d in by.items()}), {}
    for s, docs in by.items():
        total = sum(n for _, n in docs)
        base = int(target[s] // total)
        gap, left = target[s] - base * total, []

        def rank(d, mean=total / len(docs)):
            u = (int(hashlib.md5(f"{d[0]}|{mixture.SEED}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return u / (1 - u) / math.sqrt(d[1] / mean)

        for i, n in sorted(docs, key=rank):
            copies[i] = base + (n <= gap)
            gap -= n if n <= gap else 0
            left += [(i, n)] if copies[i] == base else []
        near = min(((abs(gap - n), i) for i, n in left), default=(gap, None))
        if near[0] < gap:
            copies[near[1]] += 1
    return copies


def test_a_very_long_document_does_not_end_the_sample(spark):
    sizes = [(1000 * s + i, 200 if i else 50_000, f"s{s}") for s in range(5) for i in range(301)]
    sizes += [(10_000 + i, 1 + 3 ** (i % 9), "tail") for i in range(400)]
    out = mixture.mix(spark.createDataFrame([(i, "w " * n, s) for i, n, s in sizes], "doc_id long, text string, source string")).toPandas()
    assert dict(zip(out.doc_id, out.copies)) == _one_by_one(sizes)
    per = out.assign(taken=out["size"] * out["copies"]).groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((per.taken - per.target).abs() <= 100).all()
