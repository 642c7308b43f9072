import zlib
from collections import Counter

from popcorr.llm import lang_id


def grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    s = " " + " ".join(words) + " "
    out = Counter(c for c in s if c != " ")
    out.update(s[i:i + 2] for i in range(len(s) - 1))
    out.update(s[i:i + 3] for i in range(len(s) - 2) if s[i + 1] != " ")
    return out


def top(counts, n):
    return sorted(counts, key=lambda g: (-counts[g], [0] * (3 - len(g)) + [ord(c) for c in g]))[:n]


def brute(rows, n):
    total = {}
    for d, t, lang in rows:
        if t and lang and any(c.isalpha() for c in t) and zlib.crc32(("" if d is None else str(d)).encode()) % 4 != 2:
            total.setdefault(lang, Counter()).update(grams(t))
    profiles = {k: {g: i for i, g in enumerate(top(c, n))} for k, c in sorted(total.items())}
    out = []
    for d, t, _ in rows:
        if not t or not any(c.isalpha() for c in t):
            out.append((d, "und", 0.0))
            continue
        own = top(grams(t), n)
        far = {k: sum(abs(i - p[g]) if g in p else n for i, g in enumerate(own)) for k, p in profiles.items()}
        best = min(far, key=lambda k: (far[k], k))
        out.append((d, best, round(1 - far[best] / (n * len(own)), 9)))
    return out


def test_edge_rows_against_brute_force(edge, edge_list):
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    want = brute([(d, t, lang) for d, t, lang, _ in edge_list], lang_id.PROFILE)
    rows = lang_id.identify(edge).collect()
    assert sorted(((r.doc_id, r.lang_pred, round(r.score, 9)) for r in rows), key=order) == sorted(want, key=order)
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2) for r in rows)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = lang_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 100 and (got.lang == got.lang_pred).mean() > 0.98


def test_tasks_that_hand_on_early_learn_the_same(edge, monkeypatch):
    from pyspark.sql import functions as F

    want = sorted(map(tuple, lang_id.learn(edge, F.col("text"), F.col("lang")).collect()))
    monkeypatch.setattr(lang_id, "TASK_GRAMS", 50)
    assert sorted(map(tuple, lang_id.learn(edge, F.col("text"), F.col("lang")).collect())) == want


def test_nothing_to_learn_from_and_empty_table(spark, empty):
    rows = lang_id.identify(spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]
    assert lang_id.identify(empty).count() == 0
