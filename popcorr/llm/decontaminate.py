"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters, digits and non-ASCII bytes, with A-Z lowered.
1. Every word n-gram of the test items is counted over all documents, and an
   item's rare ones (count up to its own upper quartile) become seeds.  Rare is
   relative to the item, so even an item that was copied everywhere keeps seeds.
2. Documents are read once more; where a seed occurs, the document's words
   around that place are aligned with the item (Smith-Waterman: match 2,
   mismatch -1, gap -1).  similarity = best score / (2 x item words): 1 is an
   exact copy, and each edit costs in proportion, so edited or paraphrased
   copies score below 1.  Pairs of at least ``least`` with at least
   ``LEAST_WORDS`` aligned (equal) words are leaks.
3. A few shared words are common language, not a copy.  So an item of fewer than
   ``LEAST_WORDS`` words leaks only by an exact copy of all of it, and one of fewer
   than ``ALONE_WORDS``, which any text may hold, only if the document is that item.

The test items are a stated query set: they are taken in blocks of a bounded
number of bytes (``BLOCK_BYTES``), each block broadcast to all documents.
Documents are never shuffled; the tasks hold one slice of a batch at a time.

Null and empty texts leak nothing; items without words find nothing; items
shorter than the seed length use their whole sequence.  Repeated rows each have
their own result, and an empty benchmark finds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcorr.llm import textops as T

SEED_WORDS, LEAST = 2, 0.5
LEAST_WORDS, ALONE_WORDS = 8, 4
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bytes of item texts broadcast at a time; windows aligned together.
BLOCK_BYTES, ALIGN_TOGETHER = 16 << 20, 2048
_FILTER_BITS = 22


class Items:
    """A block of test items: their words, and the n-grams (by hash) with the items and places that have them."""

    def __init__(self, rows: list[tuple[int, str]], n: int):
        self.ids = [r[0] for r in rows]
        self.n = n
        self.words: list[np.ndarray] = []
        grams, item, place = [], [], []
        for i, (_, text) in enumerate(rows):
            raw = np.frombuffer((text or "").encode(), np.uint8)
            w, _ = T.words(raw, np.array([0, len(raw)]), T.NOT_WORD)
            self.words.append(w)
            g = T.run_hashes(w, min(n, len(w))) if len(w) else w
            grams.append(g)
            item.append(np.full(len(g), i))
            place.append(np.arange(len(g)))
        self.short = sorted({len(w) for w in self.words if 0 < len(w) < n})
        self._index(np.concatenate([*grams, np.zeros(0, T.U64)]), np.concatenate([*item, np.zeros(0, int)]).astype(np.int64),
                    np.concatenate([*place, np.zeros(0, int)]).astype(np.int64))

    def state(self) -> dict:
        """The block as plain arrays, for a broadcast."""
        return dict(self.__dict__)

    @classmethod
    def of(cls, state: dict) -> Items:
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def _index(self, grams, item, place):
        order = np.argsort(grams, kind="stable")
        self.grams, self.item, self.place = grams[order], item[order], place[order]
        self.seeds, self.first = np.unique(self.grams, return_index=True)
        self.count = np.diff(np.append(self.first, len(self.grams)))
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.seeds & T.U64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True

    def keep_rare(self, seen: dict[int, int]) -> None:
        """Keep, for each item, the n-grams seen up to as often as its upper quartile."""
        n = np.array([seen.get(int(g), 0) for g in self.seeds.view(np.int64)], np.int64)
        per = np.repeat(n, self.count)
        keep = np.zeros(len(per), bool)
        order = np.argsort(self.item, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(self.item[order])) + 1) if len(order) else []:
            keep[rows] = per[rows] <= np.sort(per[rows])[(3 * (len(rows) - 1)) // 4]
        self._index(self.grams[keep], self.item[keep], self.place[keep])

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``words``, number of the seed) of every seed that occurs."""
        at, which = [], []
        for k in [self.n, *self.short]:
            g = T.run_hashes(words, k)
            maybe = np.flatnonzero(self.filter[(g & T.U64((1 << _FILTER_BITS) - 1)).astype(np.int64)]) if len(g) else np.zeros(0, np.int64)
            if len(maybe) and len(self.seeds):
                s = np.minimum(np.searchsorted(self.seeds, g[maybe]), len(self.seeds) - 1)
                hit = self.seeds[s] == g[maybe]
                at.append(maybe[hit])
                which.append(s[hit])
        return (np.concatenate(at), np.concatenate(which)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def smith_waterman(items: np.ndarray, lengths: np.ndarray, windows: np.ndarray, scale: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each item row (its first ``lengths`` words) in each window row, and the column where it ends.

    With a ``scale`` over the item's words: score x scale + the equal words of that alignment.
    Row by row over the item; gaps along the window are a running maximum.  0 in a window matches nothing.
    """
    c, w = windows.shape
    step = np.arange(w, dtype=np.int32) * (-GAP * scale)
    match = MATCH * scale + (scale > 1)
    h = np.zeros((c, w), np.int32)
    best, end = np.zeros(c, np.int32), np.zeros(c, np.int64)
    rows = np.arange(c)
    for i in range(items.shape[1]):
        live = (i < lengths)[:, None]
        diagonal = np.zeros_like(h)
        diagonal[:, 1:] = h[:, :-1]
        e = np.maximum(diagonal + np.where(items[:, i:i + 1] == windows, np.int32(match), np.int32(MISMATCH * scale)), h + GAP * scale)
        np.maximum(e, 0, out=e)
        h = np.where(live, np.maximum.accumulate(e + step, axis=1) - step, 0)
        col = h.argmax(axis=1)
        score = h[rows, col]
        better = score > best
        best, end = np.where(better, score, best), np.where(better, col, end)
    return best, end


def _windows(items: Items, doc_words: np.ndarray, before: np.ndarray):
    """Places to align: (document, item, first word, last word + 1), seeds of a place merged."""
    at, seed = items.find(doc_words)
    if not len(at):
        return None
    n = items.count[seed]
    row = T.ragged(items.first[seed], n)
    at, item = np.repeat(at, n), items.item[row]
    doc = np.searchsorted(before, at, "right") - 1
    size = np.array([len(w) for w in items.words], np.int64)
    # an n-gram that runs over the end of a document is none of its own
    inside = at + np.minimum(items.n, size[item]) <= before[doc + 1]
    at, item, doc, row = at[inside], item[inside], doc[inside], row[inside]
    if not len(at):
        return None
    begin = at - items.place[row]                         # where the item would begin
    order = np.lexsort((begin, item, doc))
    at, item, doc, begin = at[order], item[order], doc[order], begin[order]
    new = np.ones(len(begin), bool)
    new[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (begin[1:] - begin[:-1] > size[item[1:]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(begin)) - 1
    item, doc, reach = item[first], doc[first], size[item[first]]
    lo = np.maximum(begin[first] - reach // 2 - 1, before[doc])
    hi = np.minimum(begin[last] + reach + reach // 2 + 1, before[doc + 1])
    # a merged run of places that is long is cut into overlapping windows
    span, stride = 4 * reach + 2, 2 * reach
    parts = np.maximum(1, -(-(hi - lo - span) // stride) + 1)
    k = np.repeat(np.arange(len(item)), parts)
    lo = lo[k] + stride[k] * T.ragged(np.zeros(len(item), np.int64), parts)
    return doc[k], item[k], lo, np.minimum(lo + span[k], hi[k])


def _enough(score: int, item: np.ndarray, window: np.ndarray, doc_size: int) -> bool:
    """Whether so many words are equal that it is a copy: see 3. above."""
    if len(item) < LEAST_WORDS:
        return score == MATCH * len(item) and (len(item) >= ALONE_WORDS or doc_size == len(item))
    if score >= MATCH * LEAST_WORDS:                     # every equal word gives MATCH at most
        return True
    scale = len(item) + 1
    best, _ = smith_waterman(item[None, :], np.array([len(item)]), window[None, :], scale)
    return int(best[0]) % scale >= LEAST_WORDS


def align(items: Items, doc_words: np.ndarray, before: np.ndarray, least: float):
    """(document, item, similarity, first word, last word + 1) of the best alignment of each leaking pair in a slice."""
    places = _windows(items, doc_words, before)
    if places is None:
        return []
    doc, item, lo, hi = places
    size = np.array([len(w) for w in items.words], np.int64)
    found: dict[tuple[int, int], tuple[float, int, int]] = {}
    order = np.lexsort((hi - lo, size[item]))
    for start in range(0, len(order), ALIGN_TOGETHER):
        rows = order[start:start + ALIGN_TOGETHER]
        width, length = int((hi - lo)[rows].max()), int(size[item[rows]].max())
        win = np.zeros((len(rows), width), T.U64)
        its = np.ones((len(rows), length), T.U64)
        for r, x in enumerate(rows):
            win[r, :hi[x] - lo[x]] = doc_words[lo[x]:hi[x]]
            its[r, :size[item[x]]] = items.words[item[x]]
        best, end = smith_waterman(its, size[item[rows]], win)
        near = best / (MATCH * size[item[rows]])
        for r in np.flatnonzero(near >= least):
            x = rows[r]
            key = (int(doc[x]), int(item[x]))
            if key in found and found[key][0] >= near[r]:
                continue
            if not _enough(int(best[r]), items.words[item[x]], win[r], int(before[doc[x] + 1] - before[doc[x]])):
                continue
            # the start is where the reversed item ends in the reversed window up to the end found
            back = win[r:r + 1, end[r]::-1]
            _, e = smith_waterman(items.words[item[x]][::-1][None, :], size[item[x]][None], back)
            first = lo[x] + end[r] - int(e[0]) - before[doc[x]]
            found[key] = (float(near[r]), int(first), int(lo[x] + end[r] + 1 - before[doc[x]]))
    return [(d, i, *v) for (d, i), v in sorted(found.items())]


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, seed_words: int = SEED_WORDS,
          id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item, similarity, first_word, end_word): one row per leaking pair of document and test item."""
    spark = docs.sparkSession
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tests = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
    volume = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-volume // BLOCK_BYTES))
    kind, item_kind = thin.schema["id"].dataType.simpleString(), tests.schema["item"].dataType.simpleString()
    out = None
    for k in range(blocks):
        part = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k) if blocks > 1 else tests
        items = Items([tuple(r) for r in part.orderBy("item", "text").collect()], seed_words)
        every = spark.sparkContext.broadcast(items.state())

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Items.of(every.value)
            total = np.zeros(len(known.seeds), np.int64)
            for b in batches:
                for _, _, data, offsets in T.slices(b.column(0)):
                    w, _ = T.words(data, offsets, T.NOT_WORD)
                    total += np.bincount(known.find(w)[1], minlength=len(total))
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(known.seeds[seen].view(np.int64)), pa.array(total[seen])], ["gram", "n"])

        seen = thin.select("text").mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
        items.keep_rare({r[0]: r[1] for r in seen.collect()})      # at most the n-grams of the block
        rare = spark.sparkContext.broadcast(items.state())

        def search(batches: Iterator[pa.RecordBatch], rare=rare, kind=thin.schema["id"].dataType) -> Iterator[pa.RecordBatch]:
            known = Items.of(rare.value)
            for b in batches:
                for start, _, data, offsets in T.slices(b.column(1)):
                    w, before = T.words(data, offsets, T.NOT_WORD)
                    rows = align(known, w, before, least)
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [b.column(0).take(pa.array([start + r[0] for r in rows])), pa.array([known.ids[r[1]] for r in rows]),
                             pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.int64()),
                             pa.array([r[4] for r in rows], pa.int64())],
                            ["id", "item", "similarity", "first_word", "end_word"])

        one = thin.mapInArrow(search, f"id {kind}, item {item_kind}, similarity double, first_word bigint, end_word bigint")
        out = one if out is None else out.unionByName(one)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "similarity", "first_word", "end_word")
