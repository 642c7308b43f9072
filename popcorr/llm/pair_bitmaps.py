"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers read the same bytes: A space + text, B the text (it adds the
space itself).  Byte offsets at which tokens of both end cut both sequences into
groups; inside a group every A token is linked with every B token.

Units.  Neither tokenizer joins a character with a single space after it, so a
text may be cut before every space that no space precedes and no white space
follows, and the tokens of such a unit do not depend on its neighbours (for B
this is checked on its pieces when it is loaded).  Every cut is also a group
end.  A task keeps a bounded table of units it has met: their tokens, groups and
linked id pairs; texts are looked up in blocks of ``BLOCK_CHARS``.

Inverted index.  A task numbers its documents in blocks of at most
``BLOCK_DOCS`` and keeps, for each pair of ids, the documents that hold it
linked.  A block is sent on as postings: per pair a compressed bitmap of
documents, and for pairs that a document links more than once multiplicity
planes (plane k: the documents whose number of links has bit k).  A bitmap is a
sorted list of 16-bit numbers, or bits where those are shorter; ``merge_bitmaps`` ORs bitmaps of
the same block.  Blocks are disjoint ranges of documents, so the OR over blocks has as many
bits as the popcounts' sum: counts need no more than one row per pair and block.

Return of scores.  Counts and the highest count of each A id go back to the
postings; per block the planes are read back, and each document gets the links
of its best pairs and the sum of its counts.  No pair of documents, and no list
of a pair's documents beyond a block, is ever made; a pair that all documents
hold is one row per block.  Postings are written once with the documents they
number, so a lost executor cannot renumber them.

Texts that are null or empty, or whose A or B tokens do not spell space + text,
have no tokens: zeros, and '' as groups.  Repeated rows are documents of their
own and count each; null ids are kept.  Empty table: empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcorr.llm import textops as T
from popcorr.llm.token_count import byte_symbols
from popcorr.session import cut_lineage

#: Documents of a block (their numbers have 16 bits), and postings a task gathers before it sends a block on.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 16, 1_000_000
#: Characters of a text looked up together; units a task keeps, and the longest (characters) kept.
BLOCK_CHARS, TABLE_UNITS, UNIT_CHARS = 1 << 18, 600_000, 64
#: Rows of an Arrow batch of texts, and pair counts that may be broadcast (a row is 17 bytes).
BATCH_ROWS, BROADCAST_PAIRS = 500, 1_000_000
#: A pair of ids is a * SHIFT + b.
SHIFT = 1 << 24
#: Pairs of a group from which on ids that repeat in it are counted (a long run without a common end has many).
GROUP_PAIRS = 1 << 12

#: Where a text may be cut: before a space, unless a space precedes it or white space follows.
CUT = re.compile(r"(?<! ) (?=\S)")


class Tokenizers:
    """Both libraries, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        back = {s: b for b, s in byte_symbols().items()}
        with open(path_a, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.bytes_a[i] = bytes(back[c] for c in piece) if all(c in back for c in piece) else piece.encode("utf-8")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode("utf-8")
                        for p in pieces]
        #: Whether B never joins a character with a space after it.
        self.apart = not any("▁" in p.lstrip("▁") for p in pieces)
        self.size_a, self.size_b = (np.array([len(x) for x in y], np.int64) for y in (self.bytes_a, self.bytes_b))

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """(A ids, B ids) of texts that begin with a space."""
        a = self.a.encode_batch_fast(texts, add_special_tokens=False)
        return list(zip([e.ids for e in a], self.b.encode([t[1:] for t in texts], num_threads=1)))

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The A ids and B ids of units, which do not depend on their neighbours, read as one text; None if they do not spell it."""
        text = "".join(units)
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = self.b.encode(text[1:])
        raw = text.encode("utf-8")
        if b"".join(map(self.bytes_a.__getitem__, a)) == raw == b"".join(map(self.bytes_b.__getitem__, b)):
            return np.array(a, np.int64), np.array(b, np.int64)
        return None


def linked(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """(pairs, links) of one group; a small group may give a pair again, a large one gives each pair once."""
    if len(a) * len(b) <= GROUP_PAIRS:
        pairs = [i * SHIFT + j for i in a for j in b]
        return pairs, [1] * len(pairs)
    (ua, na), (ub, nb) = (np.unique(np.array(x, np.int64), return_counts=True) for x in (a, b))
    return (ua[:, None] * SHIFT + ub).ravel().tolist(), (na[:, None] * nb).ravel().tolist()


class Unit:
    """The tokens of a piece of text: whether they spell it, counts, groups as text, pairs and links."""

    __slots__ = ("good", "counts", "text", "pairs", "links")

    def __init__(self, tools: Tokenizers, text: str, a: list[int], b: list[int]):
        raw, of_a, of_b = text.encode("utf-8"), [tools.bytes_a[i] for i in a], [tools.bytes_b[i] for i in b]
        self.good = b"".join(of_a) == raw == b"".join(of_b)
        if not self.good:
            return
        parts, self.pairs, self.links = [], [], []
        i = j = from_a = from_b = end_a = end_b = 0
        while i < len(a) or j < len(b):
            # the sequence that is behind goes on; where both end a group is closed
            if end_a <= end_b:
                end_a += len(of_a[i])
                i += 1
            else:
                end_b += len(of_b[j])
                j += 1
            if end_a == end_b:
                ga, gb = a[from_a:i], b[from_b:j]
                if len(ga) == len(gb) == 1:
                    parts.append(f"{ga[0]}|{gb[0]}")
                    self.pairs.append(ga[0] * SHIFT + gb[0])
                    self.links.append(1)
                else:
                    parts.append(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}")
                    pairs, links = linked(ga, gb)
                    self.pairs += pairs
                    self.links += links
                from_a, from_b = i, j
        self.text = ";".join(parts).encode()
        self.counts = len(a), len(b), len(parts), sum(self.links)


class Places(dict):
    """unit -> its place; a new unit gets the next one and is noted in ``new``."""

    new: list[str]

    def __missing__(self, unit: str) -> int:
        place = self[unit] = len(self)
        self.new.append(unit)
        return place


class UnitTable:
    """Units met so far, their pairs in one array; when full, it keeps those that came again."""

    def __init__(self, path_a: str, path_b: str):
        self.tools = Tokenizers(path_a, path_b)
        self.clear()

    def clear(self):
        self.place = Places()
        self.place.new = []
        self.text: list[bytes | None] = []
        self.counts = np.zeros((TABLE_UNITS, 4), np.int64)
        self.start, self.many, self.hits = (np.zeros(TABLE_UNITS, np.int64) for _ in range(3))
        self.pairs, self.links, self.used = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64), 0

    def shrink(self):
        """Keeps the units that came again, if they fill less than half of the table; else the more frequent of them."""
        units, hits = list(self.place), self.hits[:len(self.text)]
        keep = np.flatnonzero(hits > 1)
        if 2 * len(keep) > TABLE_UNITS:
            keep = np.flatnonzero(hits > np.median(hits[keep]))
        text, counts, start, many = [self.text[k] for k in keep.tolist()], self.counts[keep], self.start[keep], self.many[keep]
        rows = T.ragged(start, many)
        pairs, links = self.pairs[rows], self.links[rows]
        self.clear()
        self.place.update((units[k], i) for i, k in enumerate(keep.tolist()))
        self.put(text, counts, many, pairs, links)
        self.hits[:len(keep)] = 1

    def put(self, text: list[bytes | None], counts, many: np.ndarray, pairs, links):
        """What belongs to the units of the next places."""
        rows, total = slice(len(self.text), len(self.text) + len(text)), len(pairs)
        while self.used + total > len(self.pairs):
            self.pairs, self.links = (np.concatenate((x, np.zeros_like(x))) for x in (self.pairs, self.links))
        self.pairs[self.used:self.used + total], self.links[self.used:self.used + total] = pairs, links
        self.counts[rows], self.many[rows], self.start[rows] = counts, many, self.used + np.cumsum(many) - many
        self.text += text
        self.used += total

    def learn(self, units: list[str]):
        """The units that got the last places, all at once: where tokens of both end, groups end."""
        ids = self.tools.encode_units(units) if self.tools.apart else None
        if ids is None:
            own = [Unit(self.tools, u, *x) for u, x in zip(units, self.tools.encode(units))]
            return self.put([u.text if u.good else None for u in own], [u.counts if u.good else (0, 0, 0, 0) for u in own],
                            np.array([len(u.pairs) if u.good else 0 for u in own]), [p for u in own if u.good for p in u.pairs],
                            [n for u in own if u.good for n in u.links])
        a, b = ids
        end_a, end_b = np.cumsum(self.tools.size_a[a]), np.cumsum(self.tools.size_b[b])
        ends = np.intersect1d(end_a, end_b, assume_unique=True)
        to_a, to_b = np.searchsorted(end_a, ends) + 1, np.searchsorted(end_b, ends) + 1
        from_a, from_b = (np.concatenate(([0], x[:-1])) for x in (to_a, to_b))
        many_a, many_b = to_a - from_a, to_b - from_b
        links = many_a * many_b
        group = np.repeat(np.arange(len(ends)), links)
        k = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
        pairs = a[from_a[group] + k // many_b[group]] * SHIFT + b[from_b[group] + k % many_b[group]]
        # groups of each unit
        last = np.searchsorted(ends, np.cumsum([len(u.encode("utf-8")) for u in units])) + 1
        first = np.concatenate(([0], last[:-1]))
        named_a, named_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        spans = zip(from_a.tolist(), to_a.tolist(), from_b.tolist(), to_b.tolist())
        parts = [f"{named_a[i]}|{named_b[x]}" if j - i == y - x == 1 else f"{','.join(named_a[i:j])}|{','.join(named_b[x:y])}"
                 for i, j, x, y in spans]
        text = [";".join(parts[i:j]).encode() for i, j in zip(first.tolist(), last.tolist())]
        sums = lambda x: np.add.reduceat(x, first)
        per = sums(links)
        self.put(text, np.stack((sums(many_a), sums(many_b), last - first, per), 1), per, pairs, 1)

    def block(self, units: list[str]) -> list | None:
        """[counts, groups as bytes, pairs, links] of consecutive units, or None where some do not spell their text."""
        if max(map(len, units)) <= UNIT_CHARS and len(units) <= TABLE_UNITS // 4:
            return self.known(units)
        found = []
        for long, run in groupby(units, lambda u: len(u) > UNIT_CHARS):
            if long:                                                # not kept
                for u in run:
                    unit = Unit(self.tools, u, *self.tools.encode([u])[0])
                    found.append([np.array(unit.counts), unit.text, np.array(unit.pairs, np.int64), np.array(unit.links, np.int64)]
                                 if unit.good else None)
            else:
                run, step = list(run), max(1, TABLE_UNITS // 4)
                found += [self.known(run[k:k + step]) for k in range(0, len(run), step)]
        if None in found:
            return None
        counts, text, pairs, links = zip(*found)
        return [np.sum(counts, 0), b";".join(text), np.concatenate(pairs), np.concatenate(links)]

    def known(self, units: list[str]) -> list | None:
        """As ``block``, through the table."""
        for forget in (self.shrink, self.clear):
            if len(self.text) + len(units) > TABLE_UNITS:
                forget()
        at = np.fromiter(map(self.place.__getitem__, units), np.int64, len(units))
        if self.place.new:
            self.learn(self.place.new)
            self.place.new = []
        self.hits[at] += 1
        texts = list(map(self.text.__getitem__, at.tolist()))
        if None in texts:
            return None
        rows = T.ragged(self.start[at], self.many[at])
        return [self.counts[at].sum(0), b";".join(texts), self.pairs[rows], self.links[rows]]


@lru_cache(maxsize=1)
def unit_table(path_a: str, path_b: str) -> UnitTable:
    """The table of a Python worker, for all its tasks."""
    return UnitTable(path_a, path_b)


def align(table: UnitTable, text: str | None):
    """(n_a, n_b, n_groups, n_links, SHA-256 of the groups or ''), and arrays (pairs, links) in parts; a pair may come again."""
    none = (0, 0, 0, 0, ""), []
    if not text:
        return none
    full, at, counts, sha, found = " " + text, 0, np.zeros(4, np.int64), hashlib.sha256(), []
    while at < len(full):
        cut = CUT.search(full, at + BLOCK_CHARS) if table.tools.apart and at + BLOCK_CHARS < len(full) else None
        stop = cut.start() if cut else len(full)
        first, *rest = CUT.split(full[at:stop]) if table.tools.apart else [full]
        got = table.block([*([first] if first else []), *[" " + u for u in rest]])
        if got is None:
            # units that do not spell their text: only the whole text can tell
            whole = Unit(table.tools, full, *table.tools.encode([full])[0])
            if not whole.good:
                return none
            return (*whole.counts, hashlib.sha256(whole.text).hexdigest()), [(np.array(whole.pairs, np.int64), np.array(whole.links, np.int64))]
        counts += got[0]
        sha.update((b";" if at else b"") + got[1])
        found.append((got[2], got[3]))
        at = stop
    return (*counts.tolist(), sha.hexdigest()), found


def summed(pair: np.ndarray, doc: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (pair, document, links) by pair and document, each once."""
    key = (pair << 16) | doc
    order = np.argsort(key)
    key, links = key[order], links[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    key = key[first]
    return key >> 16, key & 0xFFFF, np.add.reduceat(links, first)


# ── compressed bitmaps of 16-bit numbers ─────────────────────────────────────
#: Bytes of a bitmap held as bits; a shorter one is a sorted list of 16-bit numbers.
BITS_BYTES = BLOCK_DOCS // 8


def to_bitmap(numbers: np.ndarray) -> bytes:
    """Sorted distinct numbers below 65,536 as a compressed bitmap."""
    if 2 * len(numbers) < BITS_BYTES:
        return numbers.astype("<u2").tobytes()
    bits = np.zeros(BLOCK_DOCS, bool)
    bits[numbers] = True
    return np.packbits(bits, bitorder="little").tobytes()


def from_bitmap(raw: bytes) -> np.ndarray:
    if len(raw) < BITS_BYTES:
        return np.frombuffer(raw, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little"))


def from_bitmaps(raw: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(which bitmap, number) of all bitmaps of an array."""
    size = pc.binary_length(raw).to_numpy()
    short = np.flatnonzero(size < BITS_BYTES)
    which, at = [np.repeat(short, size[short] // 2)], [np.frombuffer(b"".join(raw.take(pa.array(short)).to_pylist()), "<u2").astype(np.int64)]
    for i in np.flatnonzero(size >= BITS_BYTES):
        at.append(from_bitmap(raw[i].as_buffer()))
        which.append(np.full(len(at[-1]), i))
    return np.concatenate(which), np.concatenate(at)


def popcount(raw: bytes) -> int:
    return len(raw) // 2 if len(raw) < BITS_BYTES else int(np.bitwise_count(np.frombuffer(raw, np.uint64)).sum())


def merge_bitmaps(x: bytes, y: bytes) -> bytes:
    """The OR of two bitmaps."""
    if len(x) == len(y) == BITS_BYTES:
        return (np.frombuffer(x, np.uint64) | np.frombuffer(y, np.uint64)).tobytes()
    return to_bitmap(np.union1d(from_bitmap(x), from_bitmap(y)))


def postings(pair: np.ndarray, doc: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """(pair, popcount, bitmap, planes) from rows as ``summed`` gives them; no planes where every document has one link."""
    first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    count = np.diff(np.append(first, len(pair)))
    most = np.maximum.reduceat(links, first)
    bitmaps = _bitmaps(doc, first, count)
    # rows of pairs with more than one link a document, once for every plane
    planes = np.where(most > 1, np.floor(np.log2(np.maximum(most, 1))).astype(np.int64) + 1, 0)
    slot0 = np.cumsum(planes) - planes
    rows = np.flatnonzero(np.repeat(planes > 0, count))
    group = np.repeat(np.arange(len(first)), count)[rows]
    slot, value = [], []
    for k in range(int(planes.max())):
        has = (links[rows] >> k) & 1 == 1
        slot.append(slot0[group[has]] + k)
        value.append(doc[rows[has]])
    slot, value = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (slot, value))
    order = np.argsort(slot, kind="stable")
    size = np.bincount(slot, minlength=int(planes.sum())) if len(slot) else np.zeros(int(planes.sum()), np.int64)
    nested = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(planes))), pa.int32()),
                                      _bitmaps(value[order], np.cumsum(size) - size, size))
    return pair[first], count, bitmaps, nested


def _bitmaps(numbers: np.ndarray, first: np.ndarray, count: np.ndarray) -> pa.Array:
    """Runs of sorted numbers as bitmaps, all in one array."""
    if not (2 * count >= BITS_BYTES).any():
        raw = numbers.astype("<u2")
        offsets = np.append(2 * first, 2 * len(raw)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(raw.tobytes())])
    return pa.array([to_bitmap(numbers[f:f + n]) for f, n in zip(first, count)], pa.binary())


_COLUMNS = ["kind", "block", "row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "n", "docs", "planes"]


def invert(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, postings): documents are (block, row, id, n_a, n_b, n_groups, n_links, groups_sha256), postings
    (block, pair, n, docs, planes) with the numbers ``row`` of the block's documents."""
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table, block, rows, held, size, kind = unit_table(path_a, path_b), TaskContext.get().partitionId() << 32, 0, [], 0, None

        def sent():
            if not held:
                return
            p, n, bitmaps, planes = postings(*summed(*(np.concatenate(x) for x in zip(*held))))
            step = 50_000
            for k in range(0, len(p), step):
                m = len(p[k:k + step])
                empty = [pa.nulls(m, t) for t in (pa.int32(), kind, *[pa.int64()] * 4, pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(m, np.int8)), pa.array(np.full(m, block)), *empty, pa.array(p[k:k + step]),
                                                  pa.array(n[k:k + step]), bitmaps.slice(k, m), planes.slice(k, m)], _COLUMNS)

        for b in batches:
            kind = b.column(0).type
            found, blocks, numbers = [], [], []
            for text in b.column(1):
                if size >= 2 * BLOCK_POSTINGS:
                    held = [summed(*(np.concatenate(x) for x in zip(*held)))]
                    size = len(held[0][0])
                if rows == BLOCK_DOCS or size >= BLOCK_POSTINGS and len(held) == 1:
                    yield from sent()
                    block, rows, held, size = block + 1, 0, [], 0
                own, parts = align(table, text.as_py())
                found.append(own)
                blocks.append(block)
                numbers.append(rows)
                for pair, links in parts:
                    held.append((pair, np.full(len(pair), rows, np.int64), links))
                    size += len(pair)
                    if size >= 4 * BLOCK_POSTINGS:              # a very long text
                        held = [summed(*(np.concatenate(x) for x in zip(*held)))]
                        size = len(held[0][0])
                rows += 1
            if found:
                cols = [pa.array(c, pa.int64()) for c in list(zip(*found))[:4]] + [pa.array([f[4] for f in found], pa.string())]
                m = len(found)
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(m, np.int8)), pa.array(blocks, pa.int64()), pa.array(numbers, pa.int32()), b.column(0), *cols,
                                                  pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()),
                                                  pa.nulls(m, pa.list_(pa.binary()))], _COLUMNS)
        yield from sent()

    kind = thin.schema["id"].dataType.simpleString()
    schema = (f"kind tinyint, block bigint, row int, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
              "groups_sha256 string, pair bigint, n bigint, docs binary, planes array<binary>")
    with T.arrow_rows(docs.sparkSession, BATCH_ROWS):
        both = cut_lineage(thin.mapInArrow(run, schema), "align_index")
    return (both.where("kind = 0").select("block", "row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"),
            both.where("kind = 1").select("block", "pair", "n", "docs", "planes"))


def pair_counts(posted: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents a pair is linked, and whether that is the highest of its A id."""
    counts = cut_lineage(posted.groupBy("pair").agg(F.sum("n").alias("count")), "align_counts")
    counts = counts.withColumn("a", F.floor(F.col("pair") / F.lit(SHIFT)))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    return cut_lineage(counts.join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best")), "align_best")


def scores(posted: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, row, n_best, count_sum): the postings' counts given back to their documents."""
    counts = F.broadcast(counts) if counts.count() <= BROADCAST_PAIRS else counts
    rows = posted.join(counts, "pair").select("block", "docs", "planes", "count", "best")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come by block; one block's sums are held at a time
        now, best, total = None, None, None

        def out():
            row = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(row), now)), pa.array(row.astype(np.int32)), pa.array(best[row]), pa.array(total[row])],
                                              ["block", "row", "n_best", "count_sum"])

        for b in batches:
            blocks, count, top = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 3, 4))
            edge = np.flatnonzero(blocks[1:] != blocks[:-1]) + 1
            for lo, hi in zip([0, *edge], [*edge, len(blocks)]):
                if lo == hi:
                    continue
                if blocks[lo] != now:
                    if now is not None:
                        yield out()
                    now, best, total = blocks[lo], np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
                docs, planes = b.column(1).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo)
                many = planes.value_lengths().to_numpy()
                single, several = np.flatnonzero(many == 0), np.repeat(np.arange(hi - lo), many)
                plane = np.arange(len(several)) - np.repeat(np.cumsum(many) - many, many)
                for raw, row, weight in ((docs.take(pa.array(single)), single, np.ones(len(single), np.int64)),
                                         (planes.flatten(), several, np.int64(1) << plane)):
                    which, at = from_bitmaps(raw)
                    weight, row = weight[which], lo + row[which]
                    np.add.at(total, at, weight * count[row])
                    np.add.at(best, at, weight * top[row])
        if now is not None:
            yield out()

    return (rows.repartition("block").sortWithinPartitions("block")
            .mapInArrow(run, "block bigint, row int, n_best bigint, count_sum bigint"))


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): per row its counts, groups' digest and scores; per pair of ids its document count and ``best``."""
    found, posted = invert(docs, path_a, path_b, id_col, text_col)
    counts = pair_counts(posted)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    out = found.join(scores(posted, counts), ["block", "row"], "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
    pairs = counts.select(F.floor(F.col("pair") / F.lit(SHIFT)).cast("int").alias("a"), F.pmod("pair", F.lit(SHIFT)).cast("int").alias("b"), "count", "best")
    return out, pairs
