"""Suffix-array dedup: bytes covered by a 50-byte string that also starts in a document with a smaller id.

Texts are UTF-8 bytes (null: empty); a string never crosses documents.

1. Shards.  Every 50-byte string has an anchor: the 8-byte string of least
   hash inside it.  Runs of consecutive strings with one anchor form a segment,
   and the anchor's hash names its shard.  Equal strings have equal anchors, so
   all that can match meet in one shard, and each string is in one segment.  A
   task packs its segments into one compressed row per shard; of equal segments
   in the same pack only those of the least id travel, the others being covered
   for certain - so a passage or text that a third of all documents share
   costs one segment per pack, not per document.
2. Shard arrays.  A shard drops segments that cannot match: a shared string has
   21 bytes or more on one side of its anchor, so a segment whose 29 bytes
   up to the anchor's end and 29 bytes from its start (wherever it holds its
   anchor) occur in one document only is single.  Of what is left, equal
   segments become one, and induced sorting gives the suffix array of their
   concatenation, block by block.  The permuted common prefixes tell which
   neighbours agree in 50 bytes: runs of these are equal strings, and a string
   is covered if the least id in its run is smaller than its own document's.
   A frequent anchor's shard grows with the input: beyond ``SPLIT_BYTES`` its
   strings are dealt again, in the task, by the 29 bytes at their anchor too,
   and of the shard only compressed rows are held whole.
3. Documents.  Covered spans are merged per document and cut out.

Merged spans are broadcast only when counted to be small (``BROADCAST_BYTES``);
otherwise they are joined with the texts by id.

A null id is smaller or larger than nothing: such rows lose and take nothing.
Rows that repeat an id are told apart by a hash of their text, and do not cover
each other.  Long texts are cut into overlapping pieces when anchors are found;
results are the same.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcorr.llm import textops as T
from popcorr.llm.induced import permuted_prefixes, suffix_array, words8
from popcorr.session import cut_lineage

LENGTH, ANCHOR = 50, 8
#: Bytes on one side of an anchor that any shared string has at least, with the anchor.
SIDE = ANCHOR + (LENGTH - ANCHOR) // 2
#: Text that a task packs together, a piece of a long text, raw segment bytes of a shard, and of a suffix array.
PACK_BYTES, PIECE, SHARD_BYTES, ARRAY_BYTES = 16 << 20, 1 << 20, 4 << 20, 2 << 20
#: Raw segment bytes beyond which a shard is dealt to finer ones, and that are hashed at a time.
SPLIT_BYTES, RUN_BYTES = 8 << 20, 1 << 18
#: Rows of an Arrow batch.
BATCH_ROWS = 500
#: Segment bytes for a byte of text: each segment has some 22 strings of its own.
BLOWUP = 3.3
BROADCAST_BYTES = 32 << 20
LEVEL = 4


def anchors(data: np.ndarray) -> np.ndarray:
    """For each 50-byte string of ``data``: the hash of its anchor."""
    least = T.mix(words8(data) * T._GOLD + T._BASE)
    count, width = LENGTH - ANCHOR + 1, 1
    while 2 * width <= count:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return np.minimum(least[:len(least) - (count - width)], least[count - width:]) if count > width else least


def segments(data: np.ndarray, offsets: np.ndarray):
    """(row, start in the row, length, place in ``data``, anchor hash) of the segments of a slice's documents."""
    if len(data) < LENGTH:
        return None
    least = anchors(data)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(least)]
    place = np.flatnonzero(np.arange(len(least)) + LENGTH <= offsets[row + 1])
    if not len(place):
        return None
    least, row = least[place], row[place]
    new = np.ones(len(place), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    start = place[first]
    return row[first], start - offsets[row[first]], place[last] - start + LENGTH, start, least[first]


def _pieces(texts: pa.Array):
    """(first row, bytes, offsets, start of the piece in its row): a long text in pieces that overlap by 49 bytes."""
    for start, stop, data, offsets in T.slices(texts):
        if stop - start > 1 or len(data) <= 2 * PIECE:
            yield start, data, offsets, 0
            continue
        for a in range(0, len(data), PIECE):
            part = data[a:a + PIECE + LENGTH - 1]
            yield start, part, np.array([0, len(part)]), a


class Pack:
    """Segments that a task holds, and their compressed rows per shard."""

    def __init__(self, shards: int):
        self.shards, self.held, self.size = shards, [], 0

    def add(self, ids, tags, found, data, base: int) -> None:
        row, start, length, place, anchor = found
        shard = (anchor >> T.U64(20)) % T.U64(self.shards)
        order = np.argsort(shard, kind="stable")
        row, start, length, place, anchor = (x[order] for x in (row, start, length, place, anchor))
        key = T.mix(T.span_hashes(data, place, place + length) * T._BASE + anchor)
        self.held.append((shard[order].astype(np.int64), ids[row], tags[row], start + base, length, key, data[T.ragged(place, length)]))
        self.size += len(data)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        shard, ids, tags, start, length, key = (np.concatenate([h[i] for h in self.held]) for i in range(6))
        data = np.concatenate([h[6] for h in self.held])
        self.held, self.size = [], 0
        place = np.cumsum(length) - length
        # of equal segments, those of the least id travel; the others are covered
        order = np.lexsort((ids, key))
        new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
        least = np.empty(len(order), np.int64)
        least[order] = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        covered = ids > least
        out = []
        if covered.any():
            spans = np.stack((ids, tags, start, start + length), 1)[covered]
            spans = merged(spans)
            out.append((int(shard[0]), 1, spans.astype("<i8").tobytes(), None))
        send = np.flatnonzero(~covered)
        send = send[np.argsort(shard[send], kind="stable")]
        cuts = np.flatnonzero(np.diff(shard[send])) + 1
        codec = pa.Codec("zstd", compression_level=LEVEL)
        for part in np.split(send, cuts):
            head = np.stack((ids[part], tags[part], start[part], length[part])).astype("<i8").tobytes()
            text = data[T.ragged(place[part], length[part])].tobytes()
            out.append((int(shard[part[0]]), 0, codec.compress(head, asbytes=True), codec.compress(text, asbytes=True), len(part), len(text)))
            if len(out) >= 256:
                yield self._batch(out)
                out = []
        if out:
            yield self._batch(out)

    @staticmethod
    def _batch(out) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int8()), pa.array([o[2] for o in out], pa.binary()),
             pa.array([o[3] for o in out], pa.binary()), pa.array([o[4] if o[1] == 0 else len(o[2]) // 32 for o in out], pa.int64()),
             pa.array([o[5] if o[1] == 0 else 0 for o in out], pa.int64())], ["shard", "kind", "head", "text", "n", "size"])


def merged(spans: np.ndarray) -> np.ndarray:
    """Rows (id, tag, start, end), those of a document that touch or overlap made one."""
    spans = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
    other = np.concatenate(([True], (spans[1:, 0] != spans[:-1, 0]) | (spans[1:, 1] != spans[:-1, 1])))
    # the furthest end so far, by document: ends are lifted by the document's number
    lift = (np.cumsum(other) - 1) * (int(spans[:, 3].max()) + 1)
    reach = np.maximum.accumulate(spans[:, 3] + lift) - lift
    new = other.copy()
    new[1:] |= spans[1:, 2] > reach[:-1]
    first = np.flatnonzero(new)
    out = spans[first].copy()
    out[:, 3] = reach[np.append(first[1:], len(spans)) - 1]
    return out


def _several(key: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether each row's key occurs with more than one id."""
    order = np.lexsort((ids, key))
    k, i = key[order], ids[order]
    new = np.concatenate(([True], k[1:] != k[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(k)) - 1
    out = np.empty(len(k), bool)
    out[order] = (i[first] != i[last])[np.cumsum(new) - 1]
    return out


def _runs(length: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first segment, bytes, lengths) of runs of segments of about ``RUN_BYTES``, so that what is computed for every byte stays small."""
    ends = np.cumsum(length)
    a = 0
    while a < len(length):
        begin = int(ends[a] - length[a])
        z = max(a + 1, int(np.searchsorted(ends, begin + RUN_BYTES, "right")))
        yield a, data[begin:int(ends[z - 1])], length[a:z]
        a = z


def marks(length: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor's hash of every segment; segment and place in ``data`` of everywhere a segment's anchor stands in it; ``words8``)."""
    ends, eight = np.cumsum(length), words8(data)
    hashed = T.mix(eight * T._GOLD + T._BASE)
    firsts = np.stack((ends - length, np.minimum(ends - length + LENGTH - ANCHOR + 1, len(hashed))), 1).ravel()
    hashed = np.append(hashed, np.full(max(0, len(data) + 1 - len(hashed)), np.iinfo(np.uint64).max, T.U64))
    anchor = np.minimum.reduceat(hashed, firsts)[::2]
    hit = np.flatnonzero(hashed[:len(data)] == np.repeat(anchor, length))
    who = np.searchsorted(ends, hit, "right")
    inside = hit + ANCHOR <= ends[who]
    return anchor, who[inside], hit[inside], eight


def contexts(eight: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the ``SIDE`` bytes at each place."""
    out = eight[at]
    for k in (*range(8, SIDE - 8, 8), SIDE - 8):
        out = T.mix(out * T._BASE + eight[at + k])
    return out


def finer(length: np.ndarray, data: np.ndarray):
    """(segment, start in it, length, place in ``data``, key) of segments cut further: strings of one key have their anchor
    first at the same side, with the same ``SIDE`` bytes up to its end (21 before it or more) or from its start.

    Equal strings have equal keys, and each string is in one of the segments.
    """
    out = []
    for a, part, own in _runs(length, data):
        _, who, mark, eight = marks(own, part)
        begin = np.cumsum(own) - own
        q = mark - begin[who]
        before = np.full(len(q), -1)
        same = who[1:] == who[:-1]
        before[1:][same] = q[:-1][same]
        lo, hi = np.maximum(np.maximum(before + 1, q - (LENGTH - ANCHOR)), 0), np.minimum(q, own[who] - LENGTH)
        far = q - (SIDE - ANCHOR)                                # the last start with so many bytes before the anchor
        base = int(length[:a].sum()) if a else 0
        for side, (s, e, first) in enumerate(((lo, np.minimum(hi, far), mark - (SIDE - ANCHOR)), (np.maximum(lo, far + 1), hi, mark))):
            some = np.flatnonzero(s <= e)
            if len(some):
                key = T.mix(contexts(eight, first[some]) + T.U64(side))
                out.append((who[some] + a, s[some], e[some] - s[some] + LENGTH, base + begin[who[some]] + s[some], key))
    return tuple(np.concatenate(x) for x in zip(*out))


def shard_spans(ids, tags, start, length, data) -> list[np.ndarray]:
    """Covered spans (id, tag, start, end) of a shard's segments."""
    place = np.cumsum(length) - length
    anchor, around = [], [[], []]
    for a, part, own in _runs(length, data):
        least, at, mark, eight = marks(own, part)
        begin, end = np.cumsum(own) - own, np.cumsum(own)
        anchor.append(least)
        # everywhere the anchor stands: the bytes to its left and to its right
        for side, first in enumerate((mark - (SIDE - ANCHOR), mark)):
            inside = np.flatnonzero((first >= begin[at]) & (first + SIDE <= end[at]))
            around[side].append((at[inside] + a, contexts(eight, first[inside])))
    anchor = np.concatenate(anchor) if anchor else np.zeros(0, T.U64)
    keep = _several(anchor, ids) if len(ids) else np.zeros(0, bool)
    if not keep.any():
        return []
    shared = np.zeros(len(ids), bool)
    for side in around:
        who, key = (np.concatenate(x) for x in zip(*side))
        kept = np.flatnonzero(keep[who])
        who, key = who[kept], key[kept]
        if len(who):
            shared[who[_several(key, ids[who])]] = True
    if not shared.any():
        return []
    data = data[T.ragged(place[shared], length[shared])]
    ids, tags, start, length, anchor = (x[shared] for x in (ids, tags, start, length, anchor))
    place = np.cumsum(length) - length
    # equal segments are one: all but those of the least id are covered
    key = T.mix(T.span_hashes(data, place, place + length) * T._BASE + anchor)
    order = np.lexsort((ids, key, anchor))
    ids, tags, start, length, place, anchor, key = (x[order] for x in (ids, tags, start, length, place, anchor, key))
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (anchor[1:] != anchor[:-1])))
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    least = ids[first]
    out = []
    late = ids > least[group]
    if late.any():
        out.append(np.stack((ids, tags, start, start + length), 1)[late])
    # blocks of whole anchors for the suffix arrays
    bounds = np.flatnonzero(np.concatenate(([True], anchor[first][1:] != anchor[first][:-1], [True])))
    volume = np.concatenate(([0], np.cumsum(length[first])))
    lo = 0
    while lo < len(bounds) - 1:
        hi = max(lo + 1, int(np.searchsorted(volume[bounds], volume[bounds[lo]] + ARRAY_BYTES, "right")) - 1)
        rows = np.arange(bounds[lo], bounds[hi])
        lo = hi
        covered = covered_runs(data, place[first][rows], length[first][rows], least[rows])
        if covered is None:
            continue
        seg, a, b = covered
        # every occurrence of the segment in its least document has these spans
        early = np.flatnonzero(~late & (group >= rows[0]) & (group <= rows[-1]))
        count = np.bincount(seg, minlength=len(rows))
        begin = np.cumsum(count) - count
        own = group[early] - rows[0]
        spans = T.ragged(begin[own], count[own])
        occ = np.repeat(early, count[own])
        if len(occ):
            out.append(np.stack((ids[occ], tags[occ], start[occ] + a[spans], start[occ] + b[spans]), 1))
    return out


def covered_runs(data, place, length, least):
    """(segment, start, end) of the covered bytes of distinct segments, by their suffix array; least: their document."""
    if (least == least[0]).all():
        return None
    # a separator after each segment; 0 ends the sequence
    begin = np.cumsum(length + 1) - (length + 1)
    raw = np.zeros(int((length + 1).sum()), np.uint8)
    raw[T.ragged(begin, length)] = data[T.ragged(place, length)]
    text = raw.astype(np.int64) + 2
    text[begin + length] = 1
    order = suffix_array(np.append(text, 0), LENGTH)
    seg = np.repeat(np.arange(len(place)), length + 1)
    order = order[order < len(raw)]
    order = order[order + LENGTH <= (begin + length)[seg[order]]]
    common = permuted_prefixes(raw, order, LENGTH)[order]
    first = np.flatnonzero(np.concatenate(([True], common[1:] < LENGTH)))
    run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    smallest = np.minimum.reduceat(least[seg[order]], first)
    covered = np.sort(order[smallest[run] < least[seg[order]]])
    if not len(covered):
        return None
    who = seg[covered]
    new = np.concatenate(([True], (who[1:] != who[:-1]) | (covered[1:] - covered[:-1] > LENGTH)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(covered)) - 1
    who = who[first]
    return who, covered[first] - begin[who], covered[last] + LENGTH - begin[who]


def unpacked(parts: list) -> tuple:
    """(ids, tags, start, length, data) of packed rows (head, text, n, size) of segments."""
    codec = pa.Codec("zstd")
    heads = [np.frombuffer(codec.decompress(h, 32 * n, asbytes=True), "<i8").reshape(4, -1) for h, _, n, _ in parts]
    data = np.concatenate([np.frombuffer(codec.decompress(t, size, asbytes=True), np.uint8) for _, t, _, size in parts])
    return *np.concatenate(heads, axis=1), data


def part_spans(parts: list) -> Iterator[np.ndarray]:
    """Covered spans (id, tag, start, end) of a shard's packed rows (emptied).

    The segments of a frequent anchor grow with the input.  A shard of more than ``SPLIT_BYTES`` is dealt by finer
    keys, row by row, to packed shards of about ``ARRAY_BYTES``, so only what is compressed grows with it.
    """
    total = sum(size for _, _, _, size in parts)
    if total <= SPLIT_BYTES:
        spans = shard_spans(*unpacked(parts))
        if spans:
            yield merged(np.concatenate(spans))
        return
    few: dict[int, list] = {}
    held = Pack(int(total * 1.5) // ARRAY_BYTES + 1)

    def dealt() -> Iterator[np.ndarray]:
        for b in held.rows():
            for shard, kind, head, text, n, size in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 1:
                    yield np.frombuffer(head, "<i8").reshape(-1, 4)
                else:
                    few.setdefault(shard, []).append((head, text, n, size))

    parts.reverse()
    while parts:
        ids, tags, start, length, data = unpacked([parts.pop()])
        row, first, size, place, key = finer(length, data)
        held.add(ids, tags, (row, start[row] + first, size, place, key), data, 0)
        if held.size >= SPLIT_BYTES:
            yield from dealt()
    yield from dealt()
    while few:
        spans = shard_spans(*unpacked(few.popitem()[1]))
        if spans:
            yield merged(np.concatenate(spans))


def covered_spans(thin: DataFrame, total_bytes: int) -> DataFrame:
    """(id, tag, start, end) of covered bytes; spans of a document may overlap.  ``thin``: id, tag, text."""
    shards = max(8, int(total_bytes * BLOWUP) // SHARD_BYTES + 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Pack(shards)
        for b in batches:
            ids, tags = b.column(0).to_numpy(), b.column(1).to_numpy()
            for start, data, offsets, base in _pieces(b.column(2)):
                found = segments(data, offsets)
                if found is not None:
                    held.add(ids[start:start + len(offsets) - 1], tags[start:start + len(offsets) - 1], found, data, base)
                if held.size >= PACK_BYTES:
                    yield from held.rows()
        yield from held.rows()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}

        def rows(spans: np.ndarray):
            for k in range(0, len(spans), 1 << 17):
                s = spans[k:k + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array(s[:, i].copy()) for i in range(4)], ["id", "tag", "start", "end"])

        for b in batches:
            for shard, kind, head, text, n, size in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 1:
                    yield from rows(np.frombuffer(head, "<i8").reshape(-1, 4))
                else:
                    parts.setdefault(shard, []).append((head, text, n, size))
        for shard in sorted(parts):
            for spans in part_spans(parts.pop(shard)):
                yield from rows(spans)

    packed = thin.where("id is not null").mapInArrow(pack, "shard int, kind tinyint, head binary, text binary, n long, size long")
    return packed.repartition(shards, "shard").mapInArrow(search, "id bigint, tag bigint, start bigint, end bigint")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row; spans: struct(start, end) of the bytes removed."""
    total, rows, ids = docs.agg(F.sum(F.octet_length(text_col)), F.count(id_col), F.count_distinct(F.col(id_col))).first()
    tag = F.lit(0).cast("long") if rows == ids else F.coalesce(F.xxhash64(text_col), F.lit(0))
    thin = docs.select(F.col(id_col).cast("long").alias("id"), tag.alias("tag"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = covered_spans(thin, total or 0)

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            flat = lists.flatten()
            n = np.diff(lists.offsets.to_numpy())
            rows = np.stack((np.repeat(b.column(0).to_numpy(), n), np.repeat(b.column(1).to_numpy(), n),
                             flat.field(0).to_numpy(), flat.field(1).to_numpy()), 1)
            one = merged(rows)
            first = np.flatnonzero(np.concatenate(([True], (one[1:, :2] != one[:-1, :2]).any(axis=1))))
            ends = np.append(first[1:], len(one))
            yield pa.RecordBatch.from_arrays(
                [pa.array(one[first, 0]), pa.array(one[first, 1]), pa.array([one[a:z, 2:].astype("<i8").tobytes() for a, z in zip(first, ends)], pa.binary())],
                ["id", "tag", "spans"])

    per = spans.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("s"))      # at most a document's length
    with T.arrow_rows(docs.sparkSession, BATCH_ROWS):
        per = cut_lineage(per.mapInArrow(join_up, "id bigint, tag bigint, spans binary"), "dedup_spans")
    volume = per.agg(F.sum(F.octet_length("spans") + F.lit(32))).first()[0] or 0
    both = thin.join(F.broadcast(per) if volume <= BROADCAST_BYTES else per, ["id", "tag"], "left").select("id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, spans in zip(b.column(1), b.column(2)):
                raw = text.as_buffer()
                raw = memoryview(raw) if raw is not None else memoryview(b"")
                s = np.frombuffer(spans.as_py(), "<i8").reshape(-1, 2).tolist() if spans.is_valid else []
                h, at = hashlib.sha256(), 0
                for a, z in s:
                    h.update(raw[at:a])
                    at = z
                h.update(raw[at:])
                out.append((len(raw), sum(z - a for a, z in s), len(s), h.hexdigest(), [{"start": a, "end": z} for a, z in s]))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string()),
                 pa.array(cols[4], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    out = both.mapInArrow(cut, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
                               "spans array<struct<start:bigint,end:bigint>>")
    return out.withColumnRenamed("id", id_col)
