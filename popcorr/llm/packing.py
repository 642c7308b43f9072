"""Packing by power-of-two decomposition.

A document of n tokens is cut, from its start on, into n // limit pieces of
``limit`` tokens and one piece for every bit of the rest, the longest first.
Every piece is a sequence of its own, so no sequence crosses documents and none
needs padding: every length is a power of two.  Sequences of equal length form a
bucket; a trainer takes each batch from one bucket.  Buckets follow each other by
length, and sequences are numbered through them without gaps.

Tokens.  Ids are those of the tokenizer file's own library, without added ids,
and ``end`` closes each document.  White space separates words in this family
of tokenizers (it is dropped), so a task gives the library each distinct word
once and keeps its ids in a bounded table; texts are then looked up word by word,
in blocks of ``BLOCK_BYTES``, so that a very long text is never held as words or
ids as a whole.  ``words_are_apart`` checks that the file is of that family;
for any other file whole texts go to the library.

Plan.  One narrow Arrow pass makes the pieces (no text is shuffled); the thin
rows of pieces are then ranked within their buckets (``rank_within``: range
partitions, so a bucket that holds a third of all pieces is dealt over tasks).

Null or empty text: the closing id alone, one piece of length 1.  Repeated rows
are documents of their own with sequences of their own; null ids keep their
pieces, last in each bucket.  Empty table: empty result.  Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcorr.llm import textops as T
from popcorr.operators.rank import rank_within
from popcorr.session import cut_lineage

LIMIT, END = 2048, 1
#: What stands between words that are encoded together; a comma or stop after a letter, a token of its own, at a word's end.
MARK, TAIL = "\x01", re.compile(rb"(?<=[A-Za-z])[.,](?![^\x20\x09-\x0D])")
#: One before a space that stands elsewhere.
ODD_TAIL = re.compile(rb"(?<![a-z])[.,](?= )")
#: Bytes of a text looked up together, words in a task's table, and their bytes.
BLOCK_BYTES, TABLE_WORDS, TABLE_BYTES = 1 << 18, 1_000_000, 32 << 20
#: Rows of an Arrow batch of texts, and tokens a task gathers before it sends pieces on.
BATCH_ROWS, BATCH_TOKENS = 500, 1 << 20


def decompose(n: int, limit: int = LIMIT) -> list[int]:
    """The lengths of the pieces of ``n`` tokens; ``limit`` is a power of two."""
    rest = n % limit
    return [limit] * (n // limit) + [1 << k for k in range(limit.bit_length() - 2, -1, -1) if rest >> k & 1]


def words_are_apart(path: str) -> tuple[bool, bool]:
    """Whether the file's normalizer and split drop white space and part letters from signs, so that words can be encoded
    one by one; and whether letters are lowered."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    drops = any(s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert")
                and {r"[\p{L}]+", r"[^\s\p{L}\p{N}]+"} <= set((s.get("pattern") or {}).get("Regex", "").split("|")) for s in steps)
    kinds = [s.get("type") for s in ((spec.get("normalizer") or {}).get("normalizers") or [])]
    marks = all(not (a["lstrip"] or a["rstrip"] or a["single_word"]) and a["content"].split() == [a["content"]]
                and a["content"].startswith("<|") for a in spec.get("added_tokens") or [])
    return drops and marks and set(kinds) <= {"NFC", "Replace", "Lowercase"}, "Lowercase" in kinds


class Places(dict):
    """word -> its place; a new word gets the next one and is noted in ``new``."""

    new: list[bytes]

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place


class WordIds:
    """The ids of texts by a table of words; ``blocks`` gives them part by part."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.apart, self.lowers = words_are_apart(path)
        mark = self.encode([MARK])[0]
        self.mark = mark[0] if len(mark) == 1 else None
        self.clear()

    def clear(self):
        self.place = Places()
        self.place.new, self.bytes = [], 0
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.count, self.hits = (np.zeros(TABLE_WORDS, np.int64) for _ in range(3))

    def shrink(self):
        """Keeps the words that came again, if they fill less than half of the table; else the more frequent of them."""
        words = list(self.place)
        hits = self.hits[:len(words)]
        keep = np.flatnonzero(hits > 1)
        if 2 * len(keep) > TABLE_WORDS:
            keep = np.flatnonzero(hits > np.median(hits[keep]))
        start, count = self.start[keep], self.count[keep]
        ids = self.ids[T.ragged(start, count)]
        self.clear()
        self.place.update((words[k], i) for i, k in enumerate(keep.tolist()))
        self.bytes = sum(map(len, self.place))
        self.ids, self.used = np.concatenate((ids, self.ids)), len(ids)
        self.start[:len(keep)], self.count[:len(keep)], self.hits[:len(keep)] = np.cumsum(count) - count, count, 1

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[bytes]):
        """Gives the words that got the last places to the library as one text, with a mark between them that is a word and a token of its own."""
        texts = [w.decode("utf-8") for w in words]
        ids = np.array(self.encode([f" {MARK} ".join(texts)])[0], np.uint32)
        cuts = np.flatnonzero(ids == self.mark) if self.mark is not None else []
        if len(cuts) != len(words) - 1:                       # a word holds the mark itself
            each = self.encode(texts)
            ids, count = np.array([i for x in each for i in x], np.uint32), np.array([len(x) for x in each], np.int64)
        else:
            count = np.diff(np.concatenate(([-1], cuts, [len(ids)]))) - 1
            ids = np.delete(ids, cuts)
        first = len(self.place) - len(words)
        self.bytes += sum(map(len, words))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used:self.used + len(ids)] = ids
        self.start[first:first + len(words)], self.count[first:first + len(words)] = self.used + np.cumsum(count) - count, count
        self.used += len(ids)

    def of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, and how many each has."""
        if len(self.place) + len(words) > TABLE_WORDS:
            self.shrink()
        if len(self.place) + len(words) > TABLE_WORDS or self.bytes > TABLE_BYTES:
            self.clear()
        if len(words) > TABLE_WORDS:
            half = len(words) // 2
            return tuple(np.concatenate(x) for x in zip(self.of_words(words[:half]), self.of_words(words[half:])))
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        if self.place.new:
            self.learn(self.place.new)
            self.place.new = []
        self.hits[at] += 1
        count = self.count[at]
        return self.ids[T.ragged(self.start[at], count)], count

    def words(self, part: bytes) -> list[bytes]:
        """A text's words as they are looked up."""
        # the tokenizer lowers letters itself, after composing them with marks (U+0300 to U+037F) that follow
        if self.lowers and not any(x in part for x in (b"<|", b"\xcc", b"\xcd")):
            part = part.lower()
        if ODD_TAIL.search(part):
            part = TAIL.sub(rb" \g<0>", part)
        else:                                                   # all of them stand after a letter
            part = part.replace(b", ", b" , ").replace(b". ", b" . ")
        # bytes.split cuts at space and U+0009 to U+000D, all of which the tokenizer drops
        return part.split()

    def blocks(self, raw: bytes) -> Iterator[np.ndarray]:
        """The ids of one text."""
        if not self.apart:
            yield np.array(self.encode([raw.decode("utf-8")])[0], np.uint32)
            return
        at = 0
        while at < len(raw):
            # a block ends before a space; one without any goes on to the next (one word)
            stop = at + BLOCK_BYTES
            stop = len(raw) if stop >= len(raw) or (stop := raw.find(b" ", stop)) < 0 else stop
            yield self.of_words(self.words(raw[at:stop]))[0]
            at = stop

    def texts(self, raws: list[bytes]) -> Iterator[Iterator[np.ndarray]]:
        """The ids of each of several texts, in parts; short ones are looked up together."""
        k = 0
        while k < len(raws):
            words, ends, size = [], [0], 0
            while self.apart and k < len(raws) and size + len(raws[k]) <= BLOCK_BYTES:
                words += self.words(raws[k])
                ends.append(len(words))
                size += len(raws[k])
                k += 1
            if len(ends) > 1:
                ids, count = self.of_words(words)
                bounds = np.concatenate(([0], np.cumsum(count)))[ends]
                yield from (iter([ids[i:j]]) for i, j in zip(bounds, bounds[1:]))
            else:
                yield self.blocks(raws[k])
                k += 1


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The table of a Python worker: tasks that follow each other in it go on with the words they know."""
    return WordIds(path)


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end: int = END,
           keep_ids: bool = True) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens[, ids]) of the pieces of every row; ``ids`` are little-endian unsigned 32-bit."""
    if limit < 1 or limit & (limit - 1):
        raise ValueError("limit is a power of two")
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if keep_ids else [])]

    def cut(ids: np.ndarray, lengths: list[int], own: list) -> np.ndarray:
        """Adds pieces of these lengths to ``own``; the ids after them."""
        at = 0
        for n in lengths:
            p = ids[at:at + n].astype("<u4").tobytes()
            own.append((n, zlib.crc32(p), *([p] if keep_ids else [])))
            at += n
        return ids[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, kind, held, rows = word_ids(path), None, 0, []

        def out():
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *[pa.array(c, pa.int64()) for c in cols[1:5]],
                                               *([pa.array(cols[5], pa.binary())] if keep_ids else [])], names)

        for b in batches:
            kind = b.column(0).type
            raws = [x or b"" for x in b.column(1).to_pylist()]
            for key, parts in zip(b.column(0).to_pylist(), words.texts(raws)):
                total, done, rest, own = 0, 0, [], []
                for part in chain(parts, [np.array([end], np.uint32)]):
                    rest.append(part)
                    total += len(part)
                    if (whole := (total - done) // limit):
                        rest = [cut(np.concatenate(rest), [limit] * whole, own)]
                        done += limit * whole
                cut(np.concatenate(rest), decompose(total - done, limit), own)
                start = 0
                for n, crc, *p in own:
                    rows.append((key, start, n, crc, total, *p))
                    start += n
                held += total
                if held >= BATCH_TOKENS or len(rows) >= 50_000:
                    yield out()
                    held, rows = 0, []
        if rows:
            yield out()

    kind = thin.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + (", ids binary" if keep_ids else "")
    with T.arrow_rows(docs.sparkSession, BATCH_ROWS):
        return cut_lineage(thin.mapInArrow(run, schema), "pack_pieces").withColumnRenamed("id", id_col)


def number(parts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``parts`` with bucket (log2 of the length), place (in the bucket, from 0), sequence_id (gapless over all buckets) and offset."""
    parts = parts.withColumn("bucket", F.round(F.log2("length")).cast("int"))
    ranked = rank_within(parts, "bucket", [F.col(id_col).asc_nulls_last(), "ids_crc32", "doc_tokens", "start"], out="place")
    sizes = {r[0]: r[1] for r in parts.groupBy("bucket").count().collect()}        # one row for each length
    before, first = {}, 0
    for b in sorted(sizes):
        before[b], first = first, first + sizes[b]
    begin = F.coalesce(*[F.when(F.col("bucket") == b, F.lit(n)) for b, n in before.items()], F.lit(0))
    return (ranked.withColumn("sequence_id", (begin + F.col("place")).cast("long"))
            .withColumn("offset", F.lit(0).cast("long")))


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end: int = END) -> DataFrame:
    """All sequences with their ids."""
    return number(pieces(docs, path, id_col, text_col, limit, end), id_col)


def write_buckets(sequences: DataFrame, path: str) -> None:
    """``pack``'s sequences as Parquet, a folder for each length, so that a batch reads sequences of one length."""
    sequences.write.partitionBy("bucket").parquet(path)
