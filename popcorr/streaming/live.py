"""Live quote refresh on Structured Streaming.

T1  a stream of quote ticks, triggered every 5 minutes (``availableNow`` in tests)
T3  per-tick KPI: change vs previous close (NULL when either is NULL or 0), every
    number cleaned first (NaN and infinite -> NULL), market cap 0 -> NULL,
    defaults currency 'USD', exchange '' where the quote carries none
T4  ticks without ticker or timestamp are skipped, counted by reason and kept in a
    quarantine table; an empty batch writes nothing
T2  one document per (ticker, minute): keyed state holds the place of each minute's
    last tick, and only a later one is passed on; state expires, and a tick that comes
    after that still meets its minute's document in the table
S10/T5  keyed upsert into the live table, never delete (series kept forever)

The live table is a list of (date, version): each date's documents are Parquet
files of the version that last wrote it (``popcorr.sources.versions``).  An
upsert reads only the dates its batch touches, merges, writes them to a folder
of its own and publishes a new list by one atomic rename; superseded folders
are removed.  A crash at any point leaves the published list as it was, and
replaying a batch gives the same documents, so the checkpointed stream and this
sink are effectively exactly-once.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampType

from popcorr.functions import kpi
from popcorr.sources import schemas, versions

DOC_KEY = "doc_id"
TICK_ORDER = ["timestamp", "seq"]
TRIGGER = "5 minutes"
PART = "_date"          # folder name of a date; the column itself stays in the files
DEFAULT_CURRENCY, DEFAULT_EXCHANGE = "USD", ""

LIVE_SCHEMA = StructType([StructField(DOC_KEY, StringType()), *schemas.QUOTE.fields,
                          StructField("seq", LongType()), StructField("date", DateType())])
LIVE_COLUMNS = LIVE_SCHEMA.names


def bar_context(bars: DataFrame) -> DataFrame:
    """Per (ticker, date): previous close and the 52-week high/low of earlier bars.

    Windows are per ticker over its trading days (bounded by the history length).
    """
    w_prev = Window.partitionBy("ticker").orderBy("date")
    w_year = (Window.partitionBy("ticker").orderBy(F.unix_date("date")).rangeBetween(-364, -1))
    return bars.select(
        "ticker", "date",
        F.lag("close").over(w_prev).alias("previous_close"),
        F.max("high").over(w_year).alias("fifty_two_week_high"),
        F.min("low").over(w_year).alias("fifty_two_week_low"))


def quote_docs(ticks: DataFrame, context: DataFrame, market_cap=None) -> DataFrame:
    """Ticks -> live documents.

    A tick has ticker, timestamp, current_price and seq; where it also carries
    previous_close, market_cap, fifty_two_week_high/low, currency or exchange,
    its own value counts, and the bar context or the default fills what is
    missing.  Works on a batch or a streaming frame (stream-static join with
    the bar context, which is tickers x days).
    """
    def number(c) -> F.Column:
        return kpi.clean_numeric((F.col(c) if isinstance(c, str) else c).cast("double"))

    own = [c for c in schemas.QUOTE.names if c in ticks.columns]
    t = (ticks.where(F.col("ticker").isNotNull() & F.col("timestamp").isNotNull())
              .withColumn("date", F.to_date("timestamp"))
              .withColumnsRenamed({c: f"own_{c}" for c in own if c not in ("ticker", "timestamp", "current_price")}))
    j = t.join(context, ["ticker", "date"], "left")

    def value(c: str) -> F.Column:
        return F.coalesce(number(f"own_{c}"), number(c)) if c in own else number(c)

    if market_cap is not None:
        cap = number(market_cap)
    else:
        cap = number("own_market_cap") if "market_cap" in own else F.lit(None).cast("double")

    def text(c: str, default: str) -> F.Column:
        return F.coalesce(F.col(f"own_{c}"), F.lit(default)) if c in own else F.lit(default)

    j = j.select("ticker", "date", "timestamp", "seq", number("current_price").alias("current_price"),
                 *[value(c).alias(c) for c in ("previous_close", "fifty_two_week_high", "fifty_two_week_low")],
                 F.when(cap != 0, cap.try_cast("long")).alias("market_cap"),
                 text("currency", DEFAULT_CURRENCY).alias("currency"), text("exchange", DEFAULT_EXCHANGE).alias("exchange"))
    return j.select(
        F.concat_ws("_", F.col("ticker"), F.date_format("timestamp", "yyyyMMddHHmm")).alias("doc_id"),
        "ticker", "timestamp", "current_price", "previous_close",
        kpi.change_pct("current_price", "previous_close").alias("change_pct"), "market_cap",
        "fifty_two_week_high", "fifty_two_week_low", "currency", "exchange",
        F.col("timestamp").alias("fetched_at"), "seq", "date")


def latest_per_key(df: DataFrame, key: str = DOC_KEY, order=TICK_ORDER) -> DataFrame:
    """The last document per key by ``order``.

    ``max_by`` over structs is a sort aggregation, in both its halves; the
    half before the shuffle leaves one copy per key and task, so replays or a
    hot key never put all copies in one task.
    """
    payload = [c for c in df.columns if c != key]
    return (df.groupBy(key)
              .agg(F.max_by(F.struct(*[F.col(c) for c in payload]),
                            F.struct(*[F.col(c) for c in order])).alias("_d"))
              .select(key, *[F.col(f"_d.{c}").alias(c) for c in payload]))


def _manifest(spark: SparkSession, path: str) -> dict[str, str]:
    """date -> version whose folder holds that date's documents."""
    return dict(line.split("\t") for line in versions.current(spark, path) or [])


def _files(path: str, manifest: dict[str, str]) -> list[str]:
    return [f"{path}/data/{v}/{PART}={d}" for d, v in sorted(manifest.items())]


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """The published live table."""
    files = _files(path, _manifest(spark, path))
    return spark.read.schema(LIVE_SCHEMA).parquet(*files) if files else spark.createDataFrame([], LIVE_SCHEMA)


def upsert(batch: DataFrame, path: str) -> int:
    """Merge a batch of documents into the live table; returns the documents of the dates it touched.

    The batch is reduced and written once (its plan may be a whole stream's);
    its dates - days of one refresh - are listed in the driver, the published
    documents of only those dates are merged in, and the result is published.
    """
    spark, path = batch.sparkSession, path.rstrip("/")
    version = uuid.uuid4().hex
    staged = f"{path}/staged/{version}"
    latest_per_key(batch.select(*[F.col(f.name).cast(f.dataType) for f in LIVE_SCHEMA.fields])).write.parquet(staged)
    docs = spark.read.schema(LIVE_SCHEMA).parquet(staged)
    dates = [r[0] for r in docs.select(F.date_format("date", "yyyy-MM-dd")).distinct().collect()]
    if not dates:
        versions.delete(spark, f"{path}/staged")
        return 0
    manifest = _manifest(spark, path)
    old = _files(path, {d: manifest[d] for d in dates if d in manifest})
    if old:
        docs = latest_per_key(spark.read.schema(LIVE_SCHEMA).parquet(*old).unionByName(docs))
    docs.withColumn(PART, F.date_format("date", "yyyy-MM-dd")).write.partitionBy(PART).parquet(f"{path}/data/{version}")
    manifest.update({d: version for d in dates})
    written = spark.read.schema(LIVE_SCHEMA).parquet(*_files(path, {d: version for d in dates})).count()
    versions.publish(spark, path, [f"{d}\t{v}" for d, v in sorted(manifest.items())])
    versions.prune(spark, path, "data")
    versions.delete(spark, f"{path}/staged")
    return written


def upsert_sink(path: str):
    """``foreachBatch`` function writing every micro-batch into the live table."""
    def _sink(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, path)
    return _sink


def start_live_refresh(ticks_stream: DataFrame, context: DataFrame, table_path: str,
                       checkpoint: str, available_now: bool = False):
    """T1-T4 + S10: ticks -> documents -> keyed upsert, one micro-batch per trigger."""
    docs = quote_docs(ticks_stream, context)
    w = docs.writeStream.foreachBatch(upsert_sink(table_path)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=TRIGGER)
    return w.start()


#: How long a minute's state outlives its last change; rows of one micro-batch arrive together, so none is ever late.
KEEP_MS, ARRIVAL_DELAY = 60 * 60 * 1000, "1 millisecond"


def newest_of_minute(docs: DataFrame, keep_ms: int = KEEP_MS) -> DataFrame:
    """Of a stream of documents those that are later than all before them of their (ticker, minute).

    The state of a key is (timestamp, seq) of its last tick.  The watermark follows the time at which ticks arrive, not
    their own, so it drops none however late, and state expires ``keep_ms`` after it changed: it holds the minutes of
    about that time, however long the stream runs.  A tick that comes when its minute's state has expired is passed on;
    the keyed upsert then keeps the later of the two.

    What a group costs in Python grows with its columns, timestamps above all: it gets one text, of its place as whole
    numbers and the document as JSON (timestamps in it as microseconds), and hands it on as it is.
    """
    times = [f.name for f in docs.schema.fields if f.dataType == TimestampType()]
    packed = F.to_json(F.struct(*[F.unix_micros(c).alias(c) if c in times else F.col(c) for c in docs.columns]))
    place = (F.unix_micros("timestamp"), F.col("seq").isNotNull().cast("int"), F.coalesce("seq", F.lit(0)))
    narrow = docs.select(DOC_KEY, F.concat_ws(" ", *place, packed).alias("doc"), F.current_timestamp().alias("arrived"))

    def step(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        before = tuple(state.get) if state.exists else None
        best, doc = before, None
        for rows in batches:
            for own in rows["doc"]:
                at = tuple(map(int, own.split(" ", 3)[:3]))
                if best is None or at > best:
                    best, doc = at, own
        if doc is not None:
            state.update(best)
        # the time of the micro-batch is what its rows have as ``arrived``
        state.setTimeoutTimestamp(max(state.getCurrentProcessingTimeMs(), state.getCurrentWatermarkMs()) + keep_ms)
        if doc is not None:
            yield pd.DataFrame({"doc": [doc]})

    out = (narrow.withWatermark("arrived", ARRIVAL_DELAY).groupBy(DOC_KEY)
           .applyInPandasWithState(step, "doc string", "at long, known int, number long", "update", "EventTimeTimeout"))
    fields = StructType([StructField(f.name, LongType() if f.name in times else f.dataType) for f in docs.schema.fields])
    doc = out.select(F.from_json(F.split("doc", " ", 4)[3], fields).alias("d"))
    return doc.select(*[(F.timestamp_micros(F.col(f"d.{c}")) if c in times else F.col(f"d.{c}")).alias(c) for c in docs.columns])


def start_latest_per_minute(ticks_stream: DataFrame, context: DataFrame, table_path: str,
                            checkpoint: str, available_now: bool = False, keep_ms: int = KEEP_MS):
    """Ticks -> documents -> last of each minute by state -> keyed upsert of what changed."""
    docs = newest_of_minute(quote_docs(ticks_stream, context).select(*LIVE_COLUMNS), keep_ms)
    w = docs.writeStream.outputMode("update").foreachBatch(upsert_sink(table_path)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=TRIGGER)
    return w.start()


# ── skipped ticks ────────────────────────────────────────────────────────────
SKIPPED = "skipped"
SKIP_REASONS = ("no ticker", "no timestamp")


def skip_reason() -> F.Column:
    """Why a tick is skipped (the first reason that holds); null for a good one."""
    return (F.when(F.col("ticker").isNull(), F.lit(SKIP_REASONS[0]))
             .when(F.col("timestamp").isNull(), F.lit(SKIP_REASONS[1])))


def start_counted_refresh(ticks_stream: DataFrame, context: DataFrame, table_path: str, quarantine_path: str,
                          checkpoint: str, available_now: bool = False):
    """As ``start_live_refresh``; skipped ticks are observed by reason and written to the quarantine table.

    A micro-batch writes its own folder there, so a batch that is run again replaces what it wrote.
    """
    ticks = ticks_stream.withColumn("reason", skip_reason())
    counts = [F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in SKIP_REASONS]
    ticks = ticks.observe(SKIPPED, F.count(F.lit(1)).alias("ticks"), *counts)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()                     # read, and observed, once
        try:
            batch.where(F.col("reason").isNotNull()).write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
            upsert(quote_docs(batch.where(F.col("reason").isNull()).drop("reason"), context), table_path)
        finally:
            batch.unpersist()

    w = ticks.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=TRIGGER)
    return w.start()


def skipped_counts(query) -> dict[str, int]:
    """Skipped ticks by reason over the query's recent micro-batches, as observed while they ran."""
    total = dict.fromkeys(("ticks", *SKIP_REASONS), 0)
    for progress in query.recentProgress:
        seen = progress["observedMetrics"].get(SKIPPED)
        if seen is not None:
            for k in total:
                total[k] += seen[k] or 0
    return total


def read_quarantine(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The ticks that were skipped, with their reason."""
    return spark.read.schema(schema.add("reason", "string")).option("recursiveFileLookup", True).parquet(path)
