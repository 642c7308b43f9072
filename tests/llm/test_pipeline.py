import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from popcorr.llm import mixture, ngram_join
from popcorr.session import cut_lineage

from test_decontaminate import cases
from test_lang_id import brute as languages
from test_ngram_join import brute as classes

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAST_BUCKETS", 4)


def _rows(df):
    return sorted(map(tuple, df.select(*corpus_pipeline.COLUMNS).collect()), key=str)


def test_stages_against_brute_force(spark, edge, edge_list, tmp_path):
    items, leaky, want = cases()
    extra = spark.createDataFrame([(d + 5000, t, "en", "s0", len(t)) for d, t in leaky[:40]], edge.select(*corpus_pipeline.COLUMNS).schema)
    docs = cut_lineage(edge.select(*corpus_pipeline.COLUMNS).unionByName(extra), "test")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    sf = str(tmp_path)

    told = cut_lineage(corpus_pipeline.language_id(spark, docs, sf), "test")
    rows = [tuple(r) for r in docs.collect()]
    keep = [r for r, p in zip(rows, languages([r[:3] for r in rows], 400)) if p[1] != "und" and p[2] >= corpus_pipeline.LEAST_SCORE]
    assert _rows(told) == sorted(keep, key=str)
    assert {r[0] for r in rows if r[1] and len(r[1]) > 200 and r[0] not in (103, 104, 105)} <= {r[0] for r in keep}

    single = cut_lineage(corpus_pipeline.near_duplicates(spark, told, sf), "test")
    order = lambda v: (v is None, v or 0)
    stay = {d for d, _, c in classes([r[:2] for r in keep]) if d == c}
    assert {order(r.doc_id) for r in single.collect()} == stay and single.count() == len(stay)
    assert sum(r.doc_id == 13 for r in single.collect()) == 1 and (13, True) in [(r.doc_id, r.text.startswith("another")) for r in single.collect()]

    clean = cut_lineage(corpus_pipeline.decontamination(spark, single, sf), "test")
    gone = {d + 5000 for d, _ in want}
    assert _rows(clean) == [r for r in _rows(single) if r[0] not in gone]

    mixed = cut_lineage(corpus_pipeline.mixing(spark, clean, sf), "test")
    copies = {r.doc_id: r.copies for r in mixture.mix(clean).collect()}
    assert _rows(mixed) == sorted([r for r in _rows(clean) for _ in range(copies[r[0]])], key=str)

    last = corpus_pipeline.sharding(spark, mixed, sf).collect()
    assert sorted(order(r.doc_id) for r in last) == sorted(order(r[0]) for r in _rows(mixed))
    run = corpus_pipeline.run(spark, sf).collect()
    assert sorted(map(tuple, run), key=str) == sorted(map(tuple, last), key=str)


def test_clashing_columns_and_missing_labels(spark, edge, tmp_path):
    plain = edge.select(*corpus_pipeline.COLUMNS)
    for stage in (corpus_pipeline.language_id, corpus_pipeline.mixing):
        out = stage(spark, edge, str(tmp_path))
        assert out.columns == corpus_pipeline.COLUMNS and _rows(out) == _rows(stage(spark, plain, str(tmp_path)))
    untold = corpus_pipeline.language_id(spark, plain.withColumn("lang", F.lit(None).cast("string")), str(tmp_path))
    letters = [r for r in plain.collect() if any(c.isalpha() for c in r.text or "")]
    assert sorted(str(r.doc_id) for r in untold.collect()) == sorted(str(r.doc_id) for r in letters)


def test_an_empty_table_goes_through(spark, empty, tmp_path):
    empty.select(*corpus_pipeline.COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_rest_imports_without_the_subpackage(tmp_path):
    for name in os.listdir(REPO):
        if name not in (".git", "corpus_pipeline.py", "popcorr", "tests"):
            os.symlink(f"{REPO}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "popcorr")
    for name in os.listdir(f"{REPO}/popcorr"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{REPO}/popcorr/{name}", tmp_path / "popcorr" / name)
    os.remove(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(open(f"{REPO}/__spark_entry__.py").read())
    code = "import re, __spark_entry__ as e; print(sum(bool(re.match('op[0-9]+_|pipeline$', k)) for k in e.queries()), len(e.queries()) > 50)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.stdout.split() == ["0", "True"], out.stderr


def test_every_operator_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 14)) and "pipeline" in names
