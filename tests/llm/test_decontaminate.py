import random

import numpy as np

from popcorr.llm import decontaminate
from popcorr.llm import textops as T


def local_score(a, b):
    """Smith-Waterman, cell by cell."""
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_against_cell_by_cell():
    rng = np.random.default_rng(2)
    items = rng.integers(1, 5, (40, 12)).astype(np.uint64)
    windows = rng.integers(1, 5, (40, 30)).astype(np.uint64)
    lengths = rng.integers(1, 13, 40)
    best, end = decontaminate.smith_waterman(items, lengths, windows)
    for r in range(40):
        a = items[r, :lengths[r]].tolist()
        assert best[r] == local_score(a, windows[r].tolist())
        assert best[r] == local_score(a, windows[r, :end[r] + 1].tolist())


def sentence(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def cases(seed=8):
    rng = random.Random(seed)
    items = [(i, " ".join(sentence(rng, rng.randint(12, 50)))) for i in range(20)]
    rows, want = [], set()
    for d in range(160):
        words = sentence(rng, rng.randint(20, 400))
        i = rng.randrange(20)
        own = items[i][1].split()
        if d % 4 == 0:                                                   # exact
            words[10:10] = own
        elif d % 4 == 1:                                                 # every sixth word changed, one lost, other marks
            own = [w if k % 6 != 2 else "other" for k, w in enumerate(own)]
            del own[len(own) // 2]
            words[5:5] = [w.upper() + "," for w in own]
        if d % 4 < 2:
            want.add((d, i))
        rows.append((d, " ".join(words)))
    return items, rows, want


def test_exact_and_edited_copies_are_found_and_clean_documents_are_not(spark):
    items, rows, want = cases()
    found = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                                spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert all(r.similarity == 1.0 for r in found if r.doc_id % 4 == 0)
    for r in found:
        if r.doc_id % 4 == 0:
            assert rows[r.doc_id][1].split()[r.first_word:r.end_word] == items[r.item_id][1].split()


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    items, rows, want = cases(9)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1500)
    found = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want


def test_an_item_copied_everywhere_keeps_its_seeds(spark):
    rng = random.Random(3)
    text = " ".join(sentence(rng, 20))
    rows = [(i, text if i % 2 else " ".join(sentence(rng, 60))) for i in range(100)]
    found = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"),
                                spark.createDataFrame([(1, text)], "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in found) == list(range(1, 100, 2))


def test_common_phrases_of_short_items_are_no_leaks(spark):
    rng = random.Random(4)
    fill = lambda n: " ".join(sentence(rng, n))
    items = [(1, "yes"), (2, "new york"), (3, "what is it called"), (4, "so what is the capital of old france"),
             (5, "what then is the capital of the far country"), (6, "who wrote the book about the green house by the lake")]
    clean = [f"{fill(20)} yes {fill(20)}", f"{fill(9)} new york {fill(9)}", f"{fill(9)} what is it {fill(9)}", f"{fill(9)} is it called {fill(9)}",
             f"{fill(9)} is the capital of {fill(9)}", f"{fill(9)} then is the capital of the {fill(9)}", f"{fill(9)} the book about the green house by {fill(9)}"]
    leaky = [("Yes.", 1), ("New York", 2), (f"{fill(9)} What is it called? {fill(9)}", 3), (f"{fill(9)} so what is the capital of old france {fill(9)}", 4),
             (f"{fill(9)} what then is the capital of the very far country {fill(9)}", 5),
             (f"{fill(9)} who wrote the old book about a green house by the lake {fill(9)}", 6)]
    rows = list(enumerate(clean + [t for t, _ in leaky]))
    found = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(len(clean) + k, i) for k, (_, i) in enumerate(leaky)}


def test_equal_words_of_an_alignment():
    item = np.arange(1, 13, dtype=np.uint64)
    window = np.array([1, 2, 99, 4, 5, 6, 8, 9, 99, 11, 12], np.uint64)          # two changed, one lost: 9 equal words
    best, _ = decontaminate.smith_waterman(item[None], np.array([12]), window[None], 13)
    assert divmod(int(best[0]), 13) == (2 * 9 - 3, 9)


def test_edge_rows(edge, edge_list, spark):
    passage = next(t for d, t, _, _ in edge_list if d == 101)
    items = spark.createDataFrame([(7, passage), (8, None), (9, ""), (10, "one"), (None, "words that nobody has written here"), (7, passage)],
                                  "item_id long, text string")
    found = decontaminate.leaks(edge, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} >= {(100, 7), (101, 7), (102, 7), (4, 10)}
    assert {r.doc_id for r in found if r.item_id == 7} == {100, 101, 102}
    assert not [r for r in found if r.item_id in (8, 9, None)]


def test_empty_tables(empty, edge, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(edge, none).count() == 0
    assert decontaminate.leaks(empty, spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0


def test_words_and_shingles_of_slices():
    import pyarrow as pa

    texts = ["Ab  cd\te", None, "", "x", " lead and trail ", "a b c d e f a b c d e f"]
    got = []
    for _, _, data, offsets in T.slices(pa.array(texts), 5):
        starts, ends, before = T.word_spans(data, offsets)
        got += [[data[a:b].tobytes().decode() for a, b in zip(starts[before[i]:before[i + 1]], ends[before[i]:before[i + 1]])]
                for i in range(len(before) - 1)]
    assert got == [(t or "").split() for t in texts]
    (_, _, data, offsets), = T.slices(pa.array(texts))
    doc, _ = T.shingles(data, offsets, 5)
    assert np.bincount(doc, minlength=6).tolist() == [1, 0, 0, 1, 1, 6]
