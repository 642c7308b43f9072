"""Sharding: minimax contiguous partition of ordered atomic groups.

Groups (documents of equal text) are atomic and ordered by the SHA-256 of the
text.  The smallest feasible capacity - the least bound on a shard's bytes for
which cutting the ordered groups greedily needs no more shards than asked for -
is found by binary search, each capacity being checked greedily; the groups
are then cut under that capacity.  Cuts at one capacity are not unique: of
those, each shard's end is the group end nearest to an even share of what is
left, between the earliest end that the later shards can still hold and the
capacity itself, so the last shards do not run empty.

Nothing is sorted or summed in one task: a group is held as up to ``salts``
chunks of its rows (so a group with a third of all rows is many chunks), and
sums over the order go through buckets of the hash.  A greedy check is a row
of look-ups "last group end up to x", each a small aggregate over a thin
written table that is laid out by those ends, so row groups are skipped.  The
ends that still matter lie between the cuts at an infeasible and a feasible
capacity; when these are few (``LOCAL_ENDS``, counted first), the search ends
in the driver, and before that each step halves the capacities by look-ups.

Null text: size 1 (no bytes plus 1), one group of its own; its CRC is null.
Repeated rows are rows of their own.  An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popcorr.session import cut_lineage

#: Rows that one window partition holds about, for chunks and for buckets of the order.
ROWS_PER_CHUNK, ROWS_PER_BUCKET = 20_000, 20_000
MIN_SALTS, MAX_BUCKETS = 64, 65_536
#: Group ends that the driver may hold to finish the search (8 bytes each).
LOCAL_ENDS = 100_000


class Ends:
    """The sorted group ends (bytes up to the end of each group), as a written table (end, size)."""

    def __init__(self, ends: DataFrame | None, total: int, local: list[int] | None = None):
        self.ends, self.total, self.local = ends, total, local

    def reach(self, starts: list[int], bounds: list[int]) -> list[int]:
        """For each start the last end up to its bound, or else the end of the one group after it."""
        if self.local is not None:
            out = []
            for a, b in zip(starts, bounds):
                k = bisect_right(self.local, b)
                far = self.local[k - 1] if k else a
                k = bisect_right(self.local, a)
                out.append(max(far, self.local[k] if k < len(self.local) else self.total))
            return out
        end = F.col("end")
        row = self.ends.where(end > min(starts)).agg(
            *[F.max(F.when(end <= b, end)) for b in bounds], *[F.min(F.when(end > a, end)) for a in starts]).first()
        n = len(starts)
        return [self.total if row[n + i] is None else max(row[i] or 0, row[n + i]) for i in range(n)]

    def nearest(self, aim: int) -> tuple[int, int]:
        """(last end up to ``aim`` or 0, first end from ``aim``)."""
        if self.local is not None:
            k, m = bisect_right(self.local, aim), bisect_left(self.local, aim)
            return self.local[k - 1] if k else 0, self.local[m] if m < len(self.local) else self.total
        end = F.col("end")
        low, high = self.ends.agg(F.max(F.when(end <= aim, end)), F.min(F.when(end >= aim, end))).first()
        return low or 0, self.total if high is None else high

    def greedy(self, capacities: list[int], shards: int) -> list[list[int]]:
        """The cuts at each capacity, cut greedily; a group above the capacity is a shard of its own."""
        at, cuts = [0] * len(capacities), [[] for _ in capacities]
        for _ in range(shards):
            at = self.reach(at, [min(a + c, self.total) for a, c in zip(at, capacities)])
            for c, a in zip(cuts, at):
                c.append(a)
        return cuts


def smallest_capacity(ends: Ends, largest: int, shards: int, above: int = 0) -> int:
    """Least capacity whose greedy cuts reach the total in ``shards`` shards.

    ``above``: bytes of the groups that are larger than an even share; they only guide where the search starts.
    """
    low, high = max(0, -(-(ends.total - above) // shards) - 1), -(-ends.total // shards) + largest
    below, over = ends.greedy([low, high], shards)
    while below[-1] >= ends.total:                          # too high a start: go down
        if low == 0:
            return 0
        high, over, low = low, below, low // 2
        below = ends.greedy([low], shards)[0]
    while high - low > 1:
        if ends.local is None:
            windows = F.lit(False)
            for a, b in zip([0, *below], [0, *over]):       # where cuts can be, and the group after each
                windows = windows | F.col("end").between(a, b + 1)
            near = ends.ends.where(windows).select("end")
            if near.limit(LOCAL_ENDS + 1).count() <= LOCAL_ENDS:
                found = {r[0] for r in near.collect()} | {ends.total}
                found |= set(ends.reach(over, over))        # the group after the last cut of each window
                ends = Ends(ends.ends, ends.total, sorted(found))
        mid = (low + high) // 2
        cuts = ends.greedy([mid], shards)[0]
        if cuts[-1] >= ends.total:
            high, over = mid, cuts
        else:
            low, below = mid, cuts
    return high


def even_cuts(ends: Ends, capacity: int, shards: int, large: list[tuple[int, int]]) -> list[int]:
    """Cuts under ``capacity``, each shard's end nearest to an even share of the rest.

    ``large``: (start, end) of the groups above the capacity, which are shards of their own.
    """
    total, starts = ends.total, dict(large)
    earliest = [total]                                      # from the last: where shard j must end at the least
    for _ in range(shards - 1):
        e = earliest[-1]
        if e <= 0:
            earliest.append(0)
            continue
        one = next((a for a, b in large if b == e), None)
        earliest.append(one if one is not None else ends.nearest(e - capacity)[1] if e > capacity else 0)
    earliest.reverse()
    at, cuts = 0, []
    for j in range(shards):
        rest = [(a, b) for a, b in large if a >= at]
        if at >= total:
            cuts.append(total)
            continue
        if at in starts:
            at = starts[at]
            cuts.append(at)
            continue
        wall = min([a for a, _ in rest], default=total)     # a large group stands here: no shard goes beyond
        small = total - at - sum(b - a for a, b in rest)
        aim = min(at + -(-small // max(1, shards - j - len(rest))), wall)
        low, high = ends.nearest(aim)
        top = min(ends.reach([at], [min(at + capacity, total)])[0], wall)
        options = [e for e in (low, high) if at < e <= top] or [top]
        at = min(max(min(options, key=lambda e: (abs(e - aim), e)), earliest[j]), top)
        cuts.append(at)
    return cuts


def ordered_chunks(rows: DataFrame, n: int) -> DataFrame:
    """Chunks (key, salt) with the rows and bytes before them in the order, and their group's end.

    Sums within hash buckets (each a bounded number of chunks), then over the
    bucket totals, of which there are at most MAX_BUCKETS.
    """
    buckets = min(MAX_BUCKETS, max(1, n // ROWS_PER_BUCKET))
    chunks = rows.groupBy("key", "salt").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))
    place = F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long")
    chunks = chunks.withColumn("bucket", F.floor(place * F.lit(buckets) / F.lit(1 << 32)).cast("int"))
    w = Window.partitionBy("bucket").orderBy("key", "salt")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    chunks = (chunks.withColumn("n_upto", F.sum("n").over(upto)).withColumn("b_upto", F.sum("b").over(upto)))
    # the group's end is the sum at its last chunk; all chunks of a group share a bucket
    chunks = chunks.withColumn("g_end", F.sum("b").over(Window.partitionBy("bucket").orderBy("key").rangeBetween(
        Window.unboundedPreceding, 0)))
    chunks = chunks.withColumn("group_bytes", F.sum("b").over(Window.partitionBy("bucket", "key")))
    totals = chunks.groupBy("bucket").agg(F.sum("n").alias("tn"), F.sum("b").alias("tb"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("bucket"), F.coalesce(F.sum("tn").over(before), F.lit(0)).alias("n0"),
                           F.coalesce(F.sum("tb").over(before), F.lit(0)).alias("b0"))
    return (chunks.join(F.broadcast(totals), "bucket")
            .select("key", "salt", (F.col("n0") + F.col("n_upto") - F.col("n")).alias("rows_before"), "n",
                    (F.col("b0") + F.col("b_upto")).alias("bytes_upto"), (F.col("b0") + F.col("g_end")).alias("end"), "group_bytes"))


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row of ``docs``; law ``bytes``."""
    text = F.col(text_col)
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    rows = cut_lineage(docs.select(F.col(id_col).alias("id"), size.alias("size"), F.crc32(text).alias("crc"),
                                   F.unhex(F.coalesce(F.sha2(text, 256), F.lit("00"))).alias("key")), "shard_rows")
    n, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not n:
        return rows.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
                           F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    salts = max(MIN_SALTS, n // ROWS_PER_CHUNK)
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    chunks = cut_lineage(ordered_chunks(rows, n), "shard_chunks")
    table = cut_lineage(chunks.where("end = bytes_upto").select("end", "group_bytes").repartitionByRange("end").sortWithinPartitions("end"), "shard_ends")
    even = -(-total // shards)
    largest, above = table.agg(F.max("group_bytes"), F.sum(F.when(F.col("group_bytes") > even, F.col("group_bytes")))).first()
    ends = Ends(table, total)
    if n <= LOCAL_ENDS:
        ends.local = sorted(r[0] for r in table.select("end").collect())
    capacity = smallest_capacity(ends, largest, shards, above or 0)
    large = table.where(F.col("group_bytes") > capacity).collect()          # each is a shard: at most ``shards``
    cuts = even_cuts(ends, capacity, shards, sorted((r["end"] - r["group_bytes"], r["end"]) for r in large))

    number: Column = F.lit(0)
    for c in cuts[:-1]:
        number = number + (F.col("end") > F.lit(c)).cast("int")
    chunks = chunks.withColumn("shard", number)
    starts = chunks.groupBy("shard").agg(F.min("rows_before").alias("first_row"))
    chunks = chunks.join(F.broadcast(starts), "shard").select(
        "key", "salt", "shard", (F.col("rows_before") - F.col("first_row")).alias("slot0"))
    within = F.row_number().over(Window.partitionBy("key", "salt").orderBy("id")) - 1
    return (rows.withColumn("_r", within).join(chunks, ["key", "salt"])
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("slot0") + F.col("_r")).cast("long").alias("slot")))
