import hashlib

from pyspark.sql import functions as F

from popcorr.llm import merkle


def _want(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        h = len(t) // 2
        out.append((d, len(t), hashlib.sha256((t[:len(t) - h] + after[:h]).encode()).hexdigest()))
    return out


def test_edited_texts(spark, edge_list):
    unique = list({d: (d, t) for d, t, _, _ in edge_list if d is not None}.values())
    got = merkle.edited_fingerprints(spark.createDataFrame(unique, "doc_id long, text string").repartition(4)).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(_want(unique))


def test_neighbours_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(merkle, "MIN_WIDTH", 4)
    rows = [(i * i, f"Text {i}. More of it {i}.\nAnd a line {i}\n") for i in range(60)]
    got = merkle.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(_want(rows))


def test_roots_test_equality_and_branches_locate_edits(spark):
    text = "".join(f"Sentence number {i} is here. " + ("\n" if i % 3 == 0 else "") for i in range(60))
    other = text.replace("number 30", "number thirty")
    rows = spark.createDataFrame([(1, text), (2, text), (3, other), (4, "a\x01b"), (5, "ab"), (6, ". \x01"), (7, ". "), (8, None), (9, "")],
                                 "doc_id long, text string")
    fp = {r.doc_id: r.fingerprint for r in merkle.fingerprints(rows).collect()}
    assert fp[1] == fp[2] and fp[8] == fp[9]
    assert len({fp[k] for k in (1, 3, 4, 5, 6, 7, 8)}) == 7
    pair = spark.createDataFrame([(fp[1], fp[3])], "a string, b string")
    near, changed = pair.select(merkle.likeness(F.col("a"), F.col("b")), merkle.changed_leaves(F.col("a"), F.col("b"))).first()
    assert 0.9 < near < 1 and len(changed) == 1
    a, b = fp[1].split(":")[1].split("."), fp[3].split(":")[1].split(".")
    assert 0 < len(set(a) - set(b)) < len(a)                     # most sections stay


def test_edge_rows(edge, edge_list):
    rows = merkle.edited_fingerprints(edge).collect()
    assert len(rows) == len(edge_list)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert merkle.edited_fingerprints(edge.where("doc_id = 100")).first().near_next == 1.0


def test_empty_table(empty):
    assert merkle.edited_fingerprints(empty).count() == 0
