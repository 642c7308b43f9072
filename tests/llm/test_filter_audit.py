import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from popcorr.llm import filter_audit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bits_of(rows):
    """(id, part, text) -> the set of letters each row fails, filter by filter."""
    out = []
    for i, part, text in rows:
        t = text or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": any(i is not None and j is not None and j < i and (u or "") == t for j, _, u in rows)}
        out.append({k for k, v in fails.items() if v})
    return out


def by_running(rows, labels, letters="ABCDE"):
    """Every order run filter by filter over the rows, as a set of tuples."""
    fails, out, removed_by = bits_of(rows), {}, Counter()
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    for part in {p or "" for _, p, _ in rows}:
        own = [(r, f) for r, f in zip(rows, fails) if (r[1] or "") == part]
        for order in permutations(letters):
            left = own
            for k, x in enumerate(order):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                removed_by[part, x] += len(gone)
                out[part, "".join(order), k + 1] = (
                    len(left), len(gone), sum(x in f for _, f in own) - len(gone), sum(f == {x} for _, f in own),
                    sum(r[0][0] in good for r in gone), sum(r[0][0] in toxic for r in gone))
    return {(*k, *v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def label_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, part string").drop("none")


@pytest.fixture(scope="module")
def labels():
    rows = [(i, i % 2, int(i % 5 == 0)) for i in range(1, 30)] + [(12, 1, 0), (None, 1, 1), (6, None, None), (10 ** 9, 1, 1)]
    best = {}
    for i, q, x in rows:
        a, b = best.get(i, (0, 0))
        best[i] = (max(a, q or 0), max(b, x or 0))
    return rows, [(i, *v) for i, v in best.items()]


def test_equals_running_every_order(spark, edge, edge_list, labels):
    rows = [(i, lang, text) for i, text, lang, _ in edge_list]
    got = A.audit(edge, label_frame(spark, [(*r, "x", "y") for r in labels[0]]))
    assert {tuple(r) for r in got.collect()} == by_running(rows, labels[1])
    assert dict(got.dtypes)["step"] == "int" and dict(got.dtypes)["shapley"] == "bigint"


def test_copies_beyond_broadcast_and_hot_groups(spark, labels, monkeypatch):
    monkeypatch.setattr(A, "BROADCAST_HASHES", 0)
    long = " ".join(f"w{i % 300}" for i in range(20_000))
    rows = ([(i, "en", "the same") for i in range(40)] + [(i, None, long) for i in (50, 51, 49)]
            + [(60, "en", "A|b " * 120), (61, "", "ABC def " * 60), (60, "de", "A|b " * 120), (None, "en", "the same")])
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(7)
    got = A.audit(docs, label_frame(spark, [(*r, "x", "y") for r in labels[0]]))
    assert {tuple(r) for r in got.collect()} == by_running(rows, labels[1])
    assert A.repeated(docs.select(F.col("doc_id").alias("id"), "text")).count() == 39 + 2


def test_other_filters_and_no_repetition_filter(spark):
    docs = spark.createDataFrame([(1, "x", "a"), (2, "x", "ab"), (3, "y", "b")], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    got = A.audit(docs, labels, filters=lambda t: {"P": t.contains("a"), "Q": t.contains("b")}, repeated_as=None)
    assert {tuple(r)[:7] for r in got.collect()} == {
        ("x", "PQ", 1, 0, 2, 0, 1), ("x", "PQ", 2, 0, 0, 1, 0), ("x", "QP", 1, 1, 1, 0, 0), ("x", "QP", 2, 0, 1, 1, 1),
        ("y", "PQ", 1, 1, 0, 0, 0), ("y", "PQ", 2, 0, 1, 0, 1), ("y", "QP", 1, 0, 1, 0, 1), ("y", "QP", 2, 0, 0, 0, 0)}


def test_empty(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(empty, labels).count() == 0
