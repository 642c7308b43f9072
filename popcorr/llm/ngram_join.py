"""N-gram Jaccard join by token-combination prefixes, and its classes.

A document's set is its distinct five-word shingles (words as runs of anything
but space and U+0009 to U+000D, A-Z lowered; fewer words: the whole sequence as
one shingle).  Two documents link when 100 x |common| >= 75 x |union|.
Shingles are 64-bit hashes.  Documents of equal sets are one node: sets are
equal by a 126-bit key; 64 bits of it (``ref``) name a set until its links are
verified, so two linked sets of one ref are the only ones a collision can part.

Token classes.  All occurrences of all shingles meet by shingle once, packed as
(32-bit head, ref) in hash buckets that grow in number with the input, which
tells three classes exactly for every task alike: shingles of one set only,
rare ones, and frequent ones (in ``FREQUENT`` sets or more).  A task that itself
meets a shingle in that many sets says so once and keeps the occurrences out of
the bucket, so no bucket gets a hot shingle's rows.  The order of prefixes is:
shingles of one set, rare, frequent, each by hash.
- A set with more than a quarter of its shingles to itself can link with none
  and ends here; most documents do.
- Rare shingles are indexed singly.
- Frequent ones are dealt into classes by hash, and within a class pairs of
  shingles (2-combinations) are indexed; a prefix that has k shingles of such a
  class counts only k - 1 of them, so it is extended until
      before + sum over classes of (k - 1) >= |x| - ceil(0.75 |x|) + 1.
  Sets that share fewer than one rare and two of each class in the shorter
  prefix have too many unshared shingles to link, so no link is lost.
  The number of classes depends on the size band of the smaller set of a pair;
  sizes that link are at most one band apart, so a set indexes its own band and
  the one below.

Joining.  Never all pairs of a group first: each indexed group links its members
to one of them only (a star around its hub, the member with the largest shared
part), and the components of the verified links follow.  Only pairs of a group
that lie in different components are left then; large groups of one hub are one
bundle, so that their pairs are made once.  While the pairs of bundles are many,
further stars around members of their largest components come first.  What is left
is tested pair by pair, large groups by blocks of members.  The shared part m of a
set bounds its overlap with any other; in a bundle each member has a bitmap of the
hub's shingles that it holds (c of them), and the bound of a pair x, y is
    popcount(bitmap(x) & bitmap(y)) + min(m(x) - c(x), m(y) - c(y));
and a pair's common shingles among the least third of both sets bound theirs; only
pairs that pass are verified on whole sets.  A group of thousands of near copies
is thus settled by a few pairs a member, and every pair between components that
could link is still tested.

Null or empty texts and texts without words have an empty set, 0 shingles,
and are linked with nothing.  Repeated rows are linked like equal texts.
Null ids keep their row and its links; they never name a component that has
another id.  Very long texts are one row of shingles in the tasks that compare
them.  Empty table: empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcorr.llm import textops as T
from popcorr.llm.graph import components
from popcorr.session import cut_lineage, release

WORDS, NUMERATOR, DENOMINATOR = 5, 75, 100
#: A shingle is frequent from this number of sets on.
FREQUENT = 24
#: Frequent shingles a class has on average; members of a group from which on it is large, and of a block of a group.
CLASS_SIZE, LARGE, BLOCK = 16, 64, 2048
#: Shingles of a bucket on average, and the least number of buckets (a power of two).
BUCKET_SHINGLES, LEAST_BUCKETS = 1_000_000, 64
#: Shingles a task packs together, and sets it remembers to skip repeats; rows of an Arrow batch; rows a later task gathers.
TASK_SHINGLES, TASK_SETS, BATCH_ROWS, TASK_ROWS = 500_000, 200_000, 500, 250_000
#: Of each set this part, by hash order, is compared first.
PREFIX_PART = 3
#: Rows that may be broadcast (two numbers each).
BROADCAST_ROWS = 1_000_000
#: Pairs between components for every member of a bundle up to which they are tested at once; further stars before that.
OPEN_PAIRS, STARS = 4096, 3


def set_keys(value: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size, ref, further 62 bits of the key) of each document's set; equal sets have equal keys."""
    n = np.bincount(doc, minlength=docs)
    ends = np.cumsum(n)

    def total(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate((np.zeros(1, T.U64), np.cumsum(x, dtype=T.U64)))
        return T.mix(sums[ends] - sums[ends - n] + n.astype(T.U64) * T._GOLD)

    return n, total(T.mix(value * T._BASE + T._GOLD)).view(np.int64), total(T.mix(value * T._BASE_INV ^ T._GOLD)) >> T.U64(2)


def wide(low: np.ndarray, high: np.ndarray) -> pa.Array:
    """126-bit keys as decimals."""
    both = np.stack((low.view(T.U64), high), 1)
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(low), [None, pa.py_buffer(np.ascontiguousarray(both).tobytes())])


KEY = "decimal(38,0)"


def _sets(batch: pa.RecordBatch, column: int):
    """(first row, size, ref, rest of the key, set starts, shingles, their row) of each slice of a batch."""
    for start, stop, data, offsets in T.slices(batch.column(column)):
        doc, value = T.shingles(data, offsets, WORDS)
        n, ref, high = set_keys(value, doc, stop - start)
        yield start, n, ref, high, np.concatenate(([0], np.cumsum(n))), value, doc


def survey(thin: DataFrame, bits: int) -> DataFrame:
    """(id, n, heads, ref, key, text_hash) of every row of (id, text, text_hash); heads: distinct codes of the set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, n, ref, high, at, value, doc in _sets(b, 1):
                code = value >> T.U64(32 - bits)
                again = np.zeros(len(code), bool)
                again[1:] = (code[1:] == code[:-1]) & (doc[1:] == doc[:-1])
                heads = n - np.bincount(doc[again], minlength=len(n))
                rows = slice(start, start + len(n))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[rows], pa.array(n, pa.int64()), pa.array(heads, pa.int64()), pa.array(ref), wide(ref, high), b.column(2)[rows]],
                    ["id", "n", "heads", "ref", "key", "text_hash"])

    kind = thin.schema["id"].dataType.simpleString()
    return thin.mapInArrow(run, f"id {kind}, n bigint, heads bigint, ref bigint, key {KEY}, text_hash bigint")


class _New:
    """Which sets a task has not met yet (a bounded memory: at worst a repeat is worked on again)."""

    def __init__(self):
        self.seen: set[int] = set()

    def __call__(self, refs: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = np.zeros(len(refs), bool)
        for i, k in enumerate(refs.tolist()):
            if n[i] and k not in self.seen:
                if len(self.seen) >= TASK_SETS:
                    self.seen.clear()
                self.seen.add(k)
                out[i] = True
        return out


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows of sorted columns begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _packed(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Runs of numbers, each as the bytes of one value."""
    offsets = np.append(first, len(values)).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())]).cast(pa.binary())


#: Kinds of packed rows: occurrences; shingles that a task found frequent itself; their occurrences (dealt by set).
SEEN, FOUND, GIVEN = 0, 1, 2
_PACKED = "bucket int, kind tinyint, refs binary, counts binary, codes binary"


def occurrences(thin: DataFrame, bits: int) -> DataFrame:
    """The shingles of every set by bucket, packed: refs, codes of each ref, codes (low 32 bits; whole for GIVEN)."""
    frequent = FREQUENT

    def rows(kind: int, bucket: np.ndarray, ref: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((ref, bucket))
        bucket, ref, code = bucket[order], ref[order], code[order]
        sets, first = _runs(bucket, ref), _runs(bucket)
        counts = np.diff(np.append(sets, len(ref))).astype("<u4")
        in_sets = np.searchsorted(sets, first)
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[first].astype(np.int32)), pa.array(np.full(len(first), kind, np.int8)), _packed(ref[sets], in_sets),
             _packed(counts, in_sets), _packed(code if kind == GIVEN else code.astype("<u4"), first)],
            ["bucket", "kind", "refs", "counts", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, held, size = _New(), [], 0

        def packed():
            code, ref = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(code)
            code, ref = code[order], ref[order]
            first = _runs(code)
            many = np.diff(np.append(first, len(code)))
            often = np.repeat(many >= frequent, many)
            if often.any():
                own = code[first[many >= frequent]]
                yield rows(FOUND, own >> T.U64(32), np.zeros(len(own), np.int64), own)
                yield rows(GIVEN, ref[often].view(T.U64) >> T.U64(64 - bits), ref[often], code[often])
            if not often.all():
                yield rows(SEEN, code[~often] >> T.U64(32), ref[~often], code[~often])

        for b in batches:
            for _, n, ref, _, at, value, doc in _sets(b, 0):
                code = value >> T.U64(32 - bits)
                part = np.repeat(new(ref, n), n)
                part[1:] &= (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
                held.append((code[part], ref[doc[part]]))
                size += int(part.sum())
                if size >= TASK_SHINGLES:
                    yield from packed()
                    held, size = [], 0
        if size:
            yield from packed()

    return thin.select("text").mapInArrow(run, _PACKED)


def shared(packed: DataFrame, bits: int) -> DataFrame:
    """(ref, m, rare, often): per set and bucket the codes that other sets have too, by class; m: how many."""
    frequent = FREQUENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs, codes, found, given = [], [], [], []
        for b in batches:
            bucket, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i in range(b.num_rows):
                raw = b.column(4)[i].as_buffer()
                ref = np.repeat(np.frombuffer(b.column(2)[i].as_buffer(), np.int64), np.frombuffer(b.column(3)[i].as_buffer(), "<u4"))
                if kind[i] == GIVEN:
                    given.append((ref, np.frombuffer(raw, T.U64)))
                    continue
                code = np.frombuffer(raw, "<u4").astype(T.U64) | T.U64(int(bucket[i]) << 32)
                if kind[i] == FOUND:
                    found.append(code)
                else:
                    refs.append(ref)
                    codes.append(code)
        out = [(r, c, np.ones(len(c), bool)) for r, c in given]
        if codes:
            code, ref = np.concatenate(codes), np.concatenate(refs)
            del codes, refs
            order = np.argsort(code)
            code, ref = code[order], ref[order]
            first = _runs(code)
            many = np.diff(np.append(first, len(code)))
            known = np.isin(code[first], np.concatenate(found)) if found else np.zeros(len(first), bool)
            keep = np.repeat((many > 1) | known, many)
            known, code, ref = np.repeat(known, many)[keep], code[keep], ref[keep]
            order = np.lexsort((ref, code))
            known, code, ref = known[order], code[order], ref[order]
            once = _runs(code, ref)                                     # repeats of a set by different tasks
            known, code, ref = known[once], code[once], ref[once]
            first = _runs(code)
            many = np.diff(np.append(first, len(code)))
            keep = np.repeat(many > 1, many) | known
            out.append((ref[keep], code[keep], (np.repeat(many >= frequent, many) | known)[keep]))
        if not out:
            return
        ref, code, often = (np.concatenate(x) for x in zip(*out))
        order = np.lexsort((code, often, ref))
        ref, code, often = ref[order], code[order], often[order]
        once = _runs(ref, code)
        ref, code, often = ref[once], code[once], often[once]
        first = _runs(ref)
        for lo in range(0, len(first), 50_000):
            f = first[lo:lo + 50_000]
            end = first[lo + 50_000] if lo + 50_000 < len(first) else len(ref)
            n = np.diff(np.append(f, end))
            r = n - np.add.reduceat(often[f[0]:end].astype(np.int64), f - f[0])
            side = [code[f[0]:end][~often[f[0]:end]], code[f[0]:end][often[f[0]:end]]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ref[f]), pa.array(n.astype(np.int64)), _packed(side[0], np.cumsum(r) - r), _packed(side[1], np.cumsum(n - r) - (n - r))],
                ["ref", "m", "rare", "often"])

    return packed.repartitionById(1 << bits, F.col("bucket")).mapInArrow(run, "ref bigint, m bigint, rare binary, often binary")


def band(n: int) -> int:
    """Size band: sizes in a ratio of at most 4/3 are at most one band apart."""
    return int(np.log(n) / np.log(4 / 3))


def combinations(frequent: np.ndarray, want: int, b: int) -> np.ndarray:
    """The 2-combination signatures of a set's frequent shingles (in order) in band ``b``, for a prefix that counts ``want``."""
    classes = max(1, int((4 / 3) ** b) // CLASS_SIZE)
    own = (T.mix(frequent + T._GOLD) % T.U64(classes)).astype(np.int64)
    first = np.zeros(len(own), bool)
    first[np.unique(own, return_index=True)[1]] = True
    stop = int(np.searchsorted(np.cumsum(~first), want)) + 1
    own, frequent = own[:stop], frequent[:stop]
    order = np.argsort(own, kind="stable")
    out = []
    for rows in np.split(order, np.flatnonzero(np.diff(own[order])) + 1):
        if len(rows) > 1:
            i, j = np.triu_indices(len(rows), 1)
            out.append(T.mix(T.mix(frequent[rows[i]] * T._BASE + frequent[rows[j]]) + np.full(len(i), b + 1, T.U64) * T._GOLD))
    return np.concatenate(out) if out else np.zeros(0, T.U64)


def signatures(n: np.ndarray, own: np.ndarray, at: np.ndarray, code: np.ndarray, often: np.ndarray):
    """(signature, row) of sets of n shingles, ``own`` of them in no other set, with the shared codes at[i]:at[i + 1]
    (rare ones first, each class by hash)."""
    need = n // 4 + 1                                           # |x| - ceil(0.75 |x|) + 1
    row = np.repeat(np.arange(len(n)), np.diff(at))
    rank = own[row] + np.arange(len(code)) - at[row]
    single = ~often & (rank < need[row])
    sig, who = [code[single]], [row[single]]
    rare = own + np.diff(at) - np.bincount(row[often], minlength=len(n))
    for i in np.flatnonzero((rare < need) & (n > 1)):
        f = code[at[i] + rare[i] - own[i]:at[i + 1]]
        b = band(int(n[i]))
        for level in (b, b - 1) if b else (b,):
            s = combinations(f, int(need[i] - rare[i]), level)
            sig.append(s)
            who.append(np.full(len(s), i))
    return np.concatenate(sig), np.concatenate(who)


def index(rows: DataFrame, tasks: int) -> DataFrame:
    """(signature, ref, n, m): the prefix index of the sets of ``rows`` (ref, n, own, total, rare, often)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for b in batches:
            ref, n, own, m = (b.column(i).to_numpy() for i in range(4))
            for side in (4, 5):
                many = np.array([len(x) // 8 if x is not None else 0 for x in b.column(side).to_pylist()], np.int64)
                code = np.frombuffer(b"".join(b.column(side).to_pylist()), T.U64)
                parts.append([np.repeat(x, many) for x in (ref, n, own, m)] + [code, np.full(len(code), side == 5)])
        if not parts:
            return
        ref, n, own, m, code, often = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((code, often, ref))
        ref, n, own, m, code, often = (x[order] for x in (ref, n, own, m, code, often))
        once = _runs(ref, code)
        ref, n, own, m, code, often = (x[once] for x in (ref, n, own, m, code, often))
        first = _runs(ref)
        for lo in range(0, len(first), 20_000):
            f = first[lo:lo + 20_000]
            end = first[lo + 20_000] if lo + 20_000 < len(first) else len(ref)
            sig, who = signatures(n[f], own[f], np.append(f, end) - f[0], code[f[0]:end], often[f[0]:end])
            who = f[who]
            for k in range(0, len(sig), 1 << 18):
                p = slice(k, k + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.array(sig[p].view(np.int64)), pa.array(ref[who[p]]), pa.array(n[who[p]]), pa.array(m[who[p]])],
                                                 ["signature", "ref", "n", "m"])

    return (rows.select("ref", "n", "own", "total", "rare", "often").repartition(tasks, "ref")
            .mapInArrow(run, "signature bigint, ref bigint, n bigint, m bigint"))


def fits(n1, m1, n2, m2):
    """Whether sets of sizes n with shared parts m can link: sizes, and the overlap that the shared parts allow."""
    return ((F.least(n1, n2) * DENOMINATOR >= F.greatest(n1, n2) * NUMERATOR)
            & (F.least(m1, m2) * (NUMERATOR + DENOMINATOR) >= (n1 + n2) * NUMERATOR))


def _ordered(a, b):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def hubs(rows: DataFrame) -> DataFrame:
    """(hub, ref, n, m, hub_n, hub_m, large): every member of a group (signature, size, ref, n, m) with the group's hub, once."""
    best = F.max(F.struct((F.col("m") * 1000 / F.col("n")).cast("long").alias("share"), "ref", "n", "m"))
    chosen = cut_lineage(rows.groupBy("signature").agg(best.alias("hub")), "join_hubs")
    both = rows.join(chosen, "signature").where(F.col("ref") != F.col("hub.ref"))
    out = (both.groupBy(F.col("hub.ref").alias("hub"), "ref")
           .agg(*[F.min(c).alias(c) for c in ("n", "m")], F.min("hub.n").alias("hub_n"), F.min("hub.m").alias("hub_m"),
                F.max(F.col("size") > LARGE).alias("large")))
    out = cut_lineage(out, "join_stars")
    release(chosen)
    return out


def again(rows: DataFrame, seed: int) -> DataFrame:
    """(a, b): the members of each bundle outside of its largest component with one member of that, where the two can link."""
    per = rows.groupBy("grp", "component").agg(F.count(F.lit(1)).alias("c"))
    main = cut_lineage(per.groupBy("grp").agg(F.max(F.struct("c", "component")).alias("x")).select("grp", F.col("x.component").alias("main")), "join_main")
    both = rows.join(main, "grp")
    one = both.where(F.col("component") == F.col("main")).groupBy("grp").agg(
        F.max(F.struct(F.xxhash64("ref", F.lit(seed)).alias("first"), "ref", "n", "m")).alias("hub"))
    one = cut_lineage(one, "join_hubs")
    out = both.where(F.col("component") != F.col("main")).join(one, "grp").where(fits(F.col("n"), F.col("m"), F.col("hub.n"), F.col("hub.m")))
    out = cut_lineage(out.select(*_ordered(F.col("ref"), F.col("hub.ref"))).distinct(), "join_pairs")
    release(main, one)
    return out


def bit_rows(bitmaps: np.ndarray) -> np.ndarray | None:
    """Bitmaps of one length as rows of 64-bit words; all ones where there is none."""
    size = max((len(x) for x in bitmaps if x is not None), default=0)
    if not size:
        return None
    words = -(-size // 8) * 8
    raw = b"".join(b"\xff" * words if x is None else x.ljust(words, b"\0") for x in bitmaps)
    return np.frombuffer(raw, T.U64).reshape(len(bitmaps), -1)


def open_pairs(rows: DataFrame, tasks: int) -> DataFrame:
    """(a, b): pairs of groups that lie in different components and can link.

    ``rows``: kind, grp, size, ref, n, m, c and held (the group's hub's shingles in the set, and their bitmap; 0 and null for
    no bound by a hub), component.  Groups above ``BLOCK`` members are dealt in blocks, each pair of blocks by itself, so a
    task works on two blocks of a group at a time.
    """
    rows = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("ref", F.lit(7)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("kind", "grp", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "ref", "n", "m", "c",
                       F.xxhash64("component").alias("component"), "own", "held")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[*(b.column(i).to_numpy() for i in range(10)), np.array(b.column(10).to_pylist() + [None], object)[:-1]] for b in batches if b.num_rows]
        if not parts:
            return
        kind, grp, x, y, ref, n, m, c, part, own, held_of = (np.concatenate(z) for z in zip(*parts))
        order = np.lexsort((n, y, x, grp, kind))
        kind, grp, x, y, ref, n, m, c, part, own, held_of = (z[order] for z in (kind, grp, x, y, ref, n, m, c, part, own, held_of))
        first = _runs(kind, grp, x, y)
        a, b, held = [], [], 0

        def out():
            both = np.unique(np.stack((np.concatenate(a), np.concatenate(b)), 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])

        for lo, hi in zip(first, np.append(first[1:], len(grp))):
            if hi - lo < 2 or (part[lo:hi] == part[lo]).all():
                continue
            k, s, o, h, p, w = ref[lo:hi], n[lo:hi], m[lo:hi] - c[lo:hi], c[lo:hi], part[lo:hi], own[lo:hi]
            upto = np.searchsorted(s * NUMERATOR, s * DENOMINATOR, "right")         # sizes 75 |y| <= 100 |x|
            bits = bit_rows(held_of[lo:hi]) if kind[lo] else None
            for at in range(0, len(k), 512):
                mine = np.arange(at, min(at + 512, len(k)))
                many = np.maximum(upto[mine] - mine - 1, 0)
                i, j = np.repeat(mine, many), T.ragged(mine + 1, many)
                least = NUMERATOR * (s[i] + s[j])
                good = (p[i] != p[j]) & ((np.minimum(h[i], h[j]) + np.minimum(o[i], o[j])) * (NUMERATOR + DENOMINATOR) >= least)
                if x[lo] != y[lo]:
                    good &= w[i] != w[j]                                            # one block each
                i, j, least = i[good], j[good], least[good]
                if bits is not None and len(i):
                    step = max(1, (32 << 20) // (8 * bits.shape[1]))
                    both = np.concatenate([np.bitwise_count(bits[i[z:z + step]] & bits[j[z:z + step]]).sum(1, dtype=np.int64)
                                           for z in range(0, len(i), step)])
                    good = (np.minimum(both, np.minimum(h[i], h[j])) + np.minimum(o[i], o[j])) * (NUMERATOR + DENOMINATOR) >= least
                    i, j = i[good], j[good]
                a.append(np.minimum(k[i], k[j]))
                b.append(np.maximum(k[i], k[j]))
                held += len(i)
                if held > 1 << 19:
                    yield out()
                    a, b, held = [], [], 0
        if held:
            yield out()

    return rows.repartition(tasks, "kind", "grp", "x", "y").mapInArrow(run, "a bigint, b bigint").distinct()


def overlap_bound(x: np.ndarray, nx: int, y: np.ndarray, ny: int) -> int:
    """An upper bound on the overlap of two sets from their sorted prefixes of 32-bit heads."""
    end = min(x[-1], y[-1])                                    # below it both prefixes are complete
    x, y = x[:np.searchsorted(x, end)], y[:np.searchsorted(y, end)]
    if not len(x) or not len(y):
        return min(nx - len(x), ny - len(y))
    in_y = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
    in_x = x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y
    return max(int(in_y.sum()), int(in_x.sum())) + min(nx - len(x), ny - len(y))


def fetch(thin: DataFrame, wanted: DataFrame) -> DataFrame:
    """(ref, key, n, shingles): the packed sorted set of each wanted ref; ``wanted`` (written) has ref and the hash of a
    text that has it, and is broadcast when counted to be small, so that no text is shuffled."""
    names = wanted.select("text_hash", F.col("ref").alias("want"))
    texts = thin.join(F.broadcast(names) if wanted.count() <= BROADCAST_ROWS else names, "text_hash").select("want", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for b in batches:
            b = b.take(pa.array([i for i, w in enumerate(b.column(0).to_pylist()) if w not in done], pa.int64()))
            want = b.column(0).to_numpy()
            for start, n, ref, high, at, value, _ in _sets(b, 1):
                rows = np.flatnonzero(ref == want[start:start + len(n)])
                rows = rows[np.unique(ref[rows], return_index=True)[1]]
                done.update(ref[rows].tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ref[rows]), wide(ref[rows], high[rows]), pa.array(n[rows], pa.int64()),
                     pa.array([value[at[i]:at[i + 1]].tobytes() for i in rows], pa.binary())], ["ref", "key", "n", "shingles"])
            if len(done) > TASK_SETS:
                done.clear()

    return texts.mapInArrow(run, f"ref bigint, key {KEY}, n bigint, shingles binary").dropDuplicates(["ref", "key"])


def _with_sets(pairs: DataFrame, sets: DataFrame, what) -> DataFrame:
    """``pairs`` (a, b) with the keys, sizes and a part of both sets: a, b, a_key, b_key, nx, ny, x, y."""
    side = lambda k, x: sets.select(F.col("ref").alias(k), F.col("key").alias(f"{k}_key"), F.col("n").alias(f"n{x}"), what.alias(x))
    return pairs.select("a", "b").join(side("b", "y"), "b").join(side("a", "x"), "a").select("a", "b", "a_key", "b_key", "nx", "ny", "x", "y")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, a_key, b_key, common, united, held) of all pairs of refs, by whole sets; held: bitmap of a's shingles that b has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, held = np.zeros(batch.num_rows, np.int64), []
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(6)[i].as_buffer(), T.U64)
                y = np.frombuffer(batch.column(7)[i].as_buffer(), T.U64)
                in_y = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
                common[i] = in_y.sum()
                held.append(np.packbits(in_y).tobytes())
            united = batch.column(4).to_numpy() + batch.column(5).to_numpy() - common
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(common), pa.array(united), pa.array(held, pa.binary())],
                                             ["a", "b", "a_key", "b_key", "common", "united", "held"])

    return _with_sets(pairs, sets, F.col("shingles")).mapInArrow(
        run, f"a bigint, b bigint, a_key {KEY}, b_key {KEY}, common bigint, united bigint, held binary")


def linked(tested: DataFrame) -> DataFrame:
    """(a, b, common, united), a and b as keys, of the tested pairs that link."""
    return (tested.where(F.col("common") * DENOMINATOR >= F.col("united") * NUMERATOR)
            .select(F.col("a_key").alias("a"), F.col("b_key").alias("b"), "common", "united"))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among pairs of refs: by the least third of both sets, then by whole ones."""
    third = F.expr(f"substring(shingles, 1, cast(8 * (n div {PREFIX_PART} + 1) as int))")

    def plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nx, ny = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            rows = [i for i in range(batch.num_rows) if (NUMERATOR + DENOMINATOR) * overlap_bound(
                np.frombuffer(batch.column(6)[i].as_buffer(), T.U64), int(nx[i]),
                np.frombuffer(batch.column(7)[i].as_buffer(), T.U64), int(ny[i])) >= NUMERATOR * int(nx[i] + ny[i])]
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(rows, pa.int64())) for k in (0, 1)], ["a", "b"])

    near = cut_lineage(_with_sets(pairs, sets, third).mapInArrow(plausible, "a bigint, b bigint").distinct(), "join_near")
    out = cut_lineage(linked(overlaps(near, sets)), "join_links")
    release(near)
    return out


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links): members are (id, n_shingles, key), links verified pairs (a, b, common, united) of set keys.

    Links hold a spanning set for each class of sets, and every link between sets that the stars left in different classes.
    Arrow batches are small: rows carry whole texts and sets.
    """
    return _join(docs, id_col, text_col)[:2]


def _join(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """members, links, and (node, component) of the keys that links reach."""
    with T.arrow_rows(docs.sparkSession, BATCH_ROWS), T.written_steps(docs.sparkSession):
        return _found(docs, id_col, text_col)


def _found(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    size = thin.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    # a shingle has about six bytes of text; buckets are a power of two
    bits = min(24, max(LEAST_BUCKETS, size // 6 // BUCKET_SHINGLES).bit_length() - 1)
    seen = cut_lineage(survey(thin, bits), "join_survey")
    members = seen.select("id", F.col("n").alias("n_shingles"), "key")
    common = cut_lineage(shared(occurrences(thin, bits), bits), "join_shared")
    sizes = seen.where("n > 0").groupBy("ref").agg(F.min("n").alias("n"), F.max("heads").alias("heads"), F.min("text_hash").alias("text_hash"))
    # sets with more than a quarter of their shingles to themselves link with none
    opened = (common.groupBy("ref").agg(F.sum("m").alias("total")).join(sizes, "ref")
              .withColumn("own", F.greatest(F.lit(0), F.col("heads") - F.col("total"))).where("own < n div 4 + 1"))
    opened = cut_lineage(opened, "join_opened")
    sets_open, left = opened.agg(F.count(F.lit(1)), F.sum("total")).first()
    few = F.broadcast(opened) if sets_open <= BROADCAST_ROWS else opened
    tasks = max(8, -(-(left or 0) // TASK_ROWS))
    found = cut_lineage(index(common.join(few.drop("heads", "text_hash"), "ref"), tasks), "join_index")
    release(common)

    groups = cut_lineage(found.groupBy("signature").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "join_groups")
    rows = cut_lineage(found.join(groups, "signature"), "join_rows")
    release(found, groups)
    wanted = cut_lineage(opened.join(rows.select("ref").distinct(), "ref").select("ref", "text_hash"), "join_wanted")
    sets = cut_lineage(fetch(thin, wanted), "join_sets")
    release(opened, wanted)

    star = hubs(rows)
    can = fits(F.col("n"), F.col("m"), F.col("hub_n"), F.col("hub_m"))
    tested = cut_lineage(overlaps(star.where(can).select(F.col("hub").alias("a"), F.col("ref").alias("b")), sets), "join_tested")
    links = cut_lineage(linked(tested), "join_links")
    done = [cut_lineage(tested.select(*_ordered(F.col("a"), F.col("b"))).distinct(), "join_pairs")]

    # small groups as they are, large ones by hub with the overlaps with it
    small = rows.where(F.col("size") <= LARGE).select(F.lit(0).alias("kind"), F.col("signature").alias("grp"), "ref", "n", "m", F.lit(0).cast("long").alias("c"),
                                                      F.lit(None).cast("binary").alias("held"))
    least = F.coalesce(F.col("common"), F.least("m", "hub_m"))
    known = tested.groupBy(F.col("a").alias("hub"), F.col("b").alias("ref")).agg(F.max("common").alias("common"), F.max("held").alias("held"))
    large = star.where("large").join(known, ["hub", "ref"], "left").select(
        F.lit(1).alias("kind"), F.col("hub").alias("grp"), "ref", "n", "m", F.least(least, F.col("m")).alias("c"), "held")
    members_of = cut_lineage(small.unionByName(large), "join_bundles")
    release(rows, star, tested)

    parts = cut_lineage(components(links.select("a", "b")), "join_parts")
    for k in range(STARS + 1):
        named = (sets.select("ref", "key").join(parts.withColumnRenamed("node", "key"), "key", "left")
                 .select("ref", F.coalesce("component", "key").alias("component")))
        now = cut_lineage(members_of.join(named, "ref"), "join_named")
        per = now.groupBy("kind", "grp", "component").agg(F.count(F.lit(1)).alias("c"))
        per = per.groupBy("kind", "grp").agg(F.sum("c").alias("size"), F.sum(F.col("c") * F.col("c")).alias("same"), F.count(F.lit(1)).alias("parts"))
        mixed = cut_lineage(per.where("parts > 1").select("kind", "grp", "size", F.expr("(size * size - same) div 2").alias("open")), "join_mixed")
        bundles = F.col("kind") == 1
        count, of_bundles, pairs = mixed.agg(F.sum("size"), F.sum(F.when(bundles, F.col("size"))), F.sum(F.when(bundles, F.col("open")))).first()
        now_open = cut_lineage(now.join(mixed.drop("open"), ["kind", "grp"]), "join_open")
        release(now, mixed)
        if not count:
            release(now_open)
            break
        if last := k == STARS or (pairs or 0) <= OPEN_PAIRS * (of_bundles or 0):
            more = open_pairs(now_open, max(8, -(-count // TASK_ROWS)))
        else:
            more = again(now_open.where(bundles), k + 1)
        for d in done:
            more = more.join(d, ["a", "b"], "left_anti")
        more = cut_lineage(more, "join_pairs")
        done.append(more)
        new = verify(more, sets)
        release(now_open)
        if not new.isEmpty():
            links = links.unionByName(new)
            release(parts)
            parts = cut_lineage(components(links.select("a", "b")), "join_parts")
        if last:
            break
    release(members_of, sets, *done)
    return members, links, parts


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row: component_id is the least id that links reach."""
    members, _, parts = _join(docs, id_col, text_col)
    parts = parts.withColumnRenamed("node", "key")
    nodes = (members.where("n_shingles > 0").groupBy("key").agg(F.min("id").alias("least")).join(parts, "key", "left")
             .select("key", "least", F.coalesce("component", "key").alias("component")))
    nodes = cut_lineage(nodes, "join_nodes")
    least = cut_lineage(nodes.groupBy("component").agg(F.min("least").alias("component_id")), "join_classes")
    named = cut_lineage(nodes.join(least, "component").select("key", "component_id"), "join_named")
    release(nodes, least)
    out = members.where("n_shingles > 0").join(named, "key").select("id", "n_shingles", "component_id")
    alone = members.where("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"))
    return out.unionByName(alone).withColumnRenamed("id", id_col)
