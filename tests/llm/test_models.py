import random

import numpy as np
import pyarrow as pa

from popcorr.llm import license_scan, lm_score


def test_windows_and_long_texts_in_pieces(monkeypatch):
    texts = ["abc", None, "", "é", "0123456789" * 30]

    def all_windows():
        out = {}
        for start, code, offsets in lm_score.pieces(pa.array(texts)):
            for i in range(len(offsets) - 1):
                out.setdefault(start + i, []).extend(code[offsets[i]:offsets[i + 1]].tolist())
        return out

    whole = all_windows()
    for i, t in enumerate(texts):
        b = (t or "").encode()
        pad = b"\0\0" + b + b"\0\0"
        want = [int.from_bytes(pad[k:k + 2] + pad[k + 3:k + 5] + pad[k + 2:k + 3], "big") for k in range(len(b))]
        assert whole.get(i, []) == want
    monkeypatch.setattr(lm_score, "PIECE", 32)
    assert {k: v for k, v in all_windows().items() if v} == {k: v for k, v in whole.items() if v}


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    p = [a.astype(np.float64) + rng.normal(0, 0.1, a.shape) for a in lm_score.initial()]
    places = rng.integers(0, 256, (6, 4))
    counts = np.zeros((6, 256))
    counts[np.arange(6), rng.integers(0, 256, 6)] = rng.integers(1, 5, 6)

    def loss():
        return -(lm_score.forward(p, places)[2] * counts).sum() / counts.sum()

    grads = lm_score.gradients(p, places, counts)
    for a, g in zip(p, grads):
        for k in [int(np.abs(g).argmax()), 0]:
            at = np.unravel_index(k, a.shape)
            old = a[at]
            a[at] = old + 1e-5
            up = loss()
            a[at] = old - 1e-5
            down = loss()
            a[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-5


def test_scores_rank_prose_above_shuffled_prose(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    weights = lm_score.train(docs.select("text"))
    texts = [t for (t,) in docs.select("text").where("char_length(text) between 300 and 3000").limit(60).collect()]
    rng = random.Random(2)
    shuffled = ["".join(rng.sample(t, len(t))) for t in texts]
    rows = [(i, t) for i, t in enumerate(texts + shuffled)]
    got = {r.doc_id: r for r in lm_score.score(spark.createDataFrame(rows, "doc_id long, text string"), weights).collect()}
    better = [got[i].mean_log_prob > got[i + len(texts)].mean_log_prob for i in range(len(texts))]
    assert np.mean(better) > 0.95
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    share = np.bincount(raw, minlength=256) / len(raw)
    alone = (share[share > 0] * np.log(share[share > 0])).sum()           # knowing how frequent each byte is
    assert sum(got[i].log_likelihood for i in range(len(texts))) / len(raw) > alone + 0.3
    # the table of windows and the network agree
    t = texts[0].encode()
    code = next(lm_score.pieces(pa.array([texts[0]])))[1]
    direct = lm_score.forward(weights, lm_score.split_context(code >> 8))[2][np.arange(len(t)), code & 255]
    assert abs(direct.sum() - got[0].log_likelihood) < 1e-2


def test_lm_edge_rows(edge, edge_list, empty, spark):
    rows = lm_score.pseudo_likelihood(edge).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len((t or "").encode()) for _, t, _, _ in edge_list)
    assert all((r.n_tokens == 0) == (r.mean_log_prob is None) and r.log_likelihood <= 0 for r in rows)
    assert lm_score.pseudo_likelihood(empty).count() == 0
    untrained = lm_score.pseudo_likelihood(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert [(r.n_tokens, r.log_likelihood) for r in untrained] == [(0, 0.0), (0, 0.0)]


def _model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return license_scan.fit(license_scan.sample_texts(docs))


def test_licence_families_and_unknown(spark, edge, edge_list, empty):
    model = _model(spark)
    rows, want = [], []
    for family, lines in license_scan.TEMPLATES.items():
        for line in lines:
            rows.append((len(rows), f"first prose line\n{line}\nlast line"))
            want.append((family, 1))
            rows.append((len(rows), line + " And some words of prose after it."))
            want.append((family, 0))
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    hits = [any(f.family == w[0] and f.paragraph == w[1] and f.confirmed for f in got[i].found) for i, w in enumerate(want)]
    assert np.mean(hits) >= 0.95 and all(hits[::2])
    assert all(got[i].n_paragraphs == (3 if i % 2 == 0 else 1) for i in got)
    # prose without a licence, with words that licences have too
    prose = [(i, "the work of the license is under version and free software text " * 2) for i in range(3)]
    assert not any(f.confirmed for r in license_scan.scan(spark.createDataFrame(prose, "doc_id long, text string"), model).collect() for f in r.found)
    rows = license_scan.scan(edge, model).collect()
    assert len(rows) == len(edge_list) and not any(f.confirmed for r in rows for f in r.found)
    assert license_scan.scan(empty, model).count() == 0


def test_licence_lines_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = license_scan.scan(docs, license_scan.fit(license_scan.sample_texts(docs))).collect()
    texts = dict(docs.select("doc_id", "text").collect())
    known = {line for lines in license_scan.TEMPLATES.values() for line in lines}
    for r in got:
        lines = texts[r.doc_id].split("\n")
        assert [f.paragraph for f in r.found if f.confirmed] == [i for i, line in enumerate(lines) if line in known]


def test_fit_without_any_text():
    model = license_scan.fit([])
    assert model.threshold >= 0.5


def test_wrapped_notices(spark):
    import textwrap

    lines = [(f, line) for f, x in license_scan.TEMPLATES.items() for line in x if len(line) > 100]
    rows, want = [], []
    for family, line in lines:
        for width, mark in ((40, "# "), (72, " * "), (60, "")):
            body = "\n".join(mark + x for x in textwrap.wrap(line, width))
            rows.append((len(rows), f"some prose before it\n\n{body}\n\nand some prose after it"))
            want.append(family)
    mit = ('Copyright (c) 2020 A. Writer\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n'
           'of this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\n'
           'to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software.')
    rows.append((len(rows), mit))
    want.append("MIT")
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), _model(spark)).collect()}
    assert [(i, w) for i, w in enumerate(want) if {f.family for f in got[i].found if f.confirmed} != {w}] == []
    assert [f.paragraph for f in got[len(rows) - 1].found if f.confirmed] == [2]


def test_near_misses_are_not_the_family_they_resemble(spark):
    near = {"Licensed under CC BY-SA 4.0.": "CC-BY-SA", "Licensed under CC BY-ND 4.0.": "CC-BY-ND", "Licensed under CC BY-XY 4.0.": None,
            "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
            "This work is licensed under the GNU Other General Public License, version 3.": None,
            "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA",
            "This work is licensed under the GNU General Public License, version 4.": None,
            "Licensed under the Apache License, Version 1.1.": None}
    docs = spark.createDataFrame(list(enumerate(near)), "doc_id long, text string")
    got = {r.doc_id: {f.family for f in r.found if f.confirmed} for r in license_scan.scan(docs, _model(spark)).collect()}
    assert [got[i] for i in range(len(near))] == [{f} if f else set() for f in near.values()]
    _, label = license_scan.training_paragraphs(["Licensed under CC BY-XY 4.0."])
    lines, _ = license_scan.training_paragraphs(["Licensed under CC BY-XY 4.0.\nReleased under the MIT License."])
    assert lines[0] == "Licensed under CC BY-XY 4.0." and label[0] == len(license_scan.FAMILIES) - 1
