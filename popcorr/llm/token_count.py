"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut into pieces by the vocabulary's split pattern; each piece starts
as one symbol per UTF-8 byte, held in a linked list, and a heap of adjacent
pairs gives the pair of lowest rank (leftmost first) again and again until no
pair has a rank.  The count is initial symbols minus merges; no identifier is
ever looked up.  A piece of n bytes costs O(n log n), so one long run without
spaces is no problem.

Added tokens of the vocabulary file (such as an end-of-text mark) that occur
in a text count as one token each, as the file's own library treats them by
default.  The merge list (a fixed vocabulary file, a few MB) is the only
broadcast; tasks keep a bounded cache of piece counts.

Null text: 0 bytes, 0 tokens.  Empty text: 0, 0.  Repeated rows give repeated
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the split pattern that byte-level vocabularies of this family are made for.
SPLIT_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Entries in a task's cache of piece counts, and the longest piece kept there.
CACHE_PIECES, CACHE_CHARS = 600_000, 48
OVER_LIMIT = 1024


def byte_symbols() -> dict[int, str]:
    """Byte -> printable symbol: printable Latin-1 stays, the rest moves above U+0100."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in keep}
    moved = (b for b in range(256) if b not in table)
    table.update({b: chr(0x100 + i) for i, b in enumerate(list(moved))})
    return table


def load_vocabulary(path: str) -> tuple[list[tuple[str, str]], list[str]]:
    """(merges in rank order, added token strings) of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    return pairs, [t["content"] for t in spec.get("added_tokens") or []]


def count_symbols(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left after merging: repeatedly pop the lowest-rank adjacent pair."""
    n = len(symbols)
    if n < 2:
        return n
    sym = list(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((sym[i], sym[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = right[i]
        # a stale entry: the symbol is gone, is the last, or its pair has changed
        if sym[i] is None or j >= n or ranks.get((sym[i], sym[j])) != rank:
            continue
        sym[i] += sym[j]
        sym[j] = None
        merges += 1
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            if (r := ranks.get((sym[i], sym[k]))) is not None:
                heapq.heappush(heap, (r, i))
        h = left[i]
        if h >= 0 and (r := ranks.get((sym[h], sym[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return n - merges


class PieceCounts(dict):
    """piece -> tokens, filled on demand; emptied when full, so memory is bounded."""

    def __init__(self, pairs: list[tuple[str, str]]):
        super().__init__()
        self.ranks = {p: i for i, p in enumerate(pairs)}
        self.table = {b: s for b, s in byte_symbols().items()}

    def __missing__(self, piece: str) -> int:
        n = count_symbols([self.table[b] for b in piece.encode("utf-8")], self.ranks)
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = n
        return n


def text_counter(pairs: list[tuple[str, str]], added: list[str]):
    """A function text -> number of tokens."""
    counts, pieces = PieceCounts(pairs), regex.compile(SPLIT_PATTERN).findall
    marks = re.compile("|".join(re.escape(a) for a in sorted(added, key=len, reverse=True))) if added else None

    def count(text: str | None) -> int:
        if not text:
            return 0
        parts = marks.split(text) if marks else [text]
        look = counts.__getitem__
        return len(parts) - 1 + sum(sum(map(look, pieces(p))) for p in parts)

    return count


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for every row of ``docs``; one narrow Arrow pass, no shuffle."""
    merges = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = text_counter(*merges.value)
        for b in batches:
            n = [count(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["id", "n_tokens"])

    kind = thin.schema["id"].dataType.simpleString()
    sized = thin.select(F.struct("id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")).alias("id"), "text")
    out = sized.mapInArrow(run, f"id struct<id:{kind},n_bytes:bigint>, n_tokens bigint")
    return out.select(F.col("id.id").alias(id_col), F.col("id.n_bytes").alias("n_bytes"), "n_tokens")
