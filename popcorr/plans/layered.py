"""The layered flow: raw -> formatted Parquet -> combine -> usage Parquet.

``formatted_inputs`` runs the three format steps (and the stream name
dimension) over the driver tables of one scale, writes each as a
``run_date``-partitioned Parquet table under the shared checkpoint folder,
and reads them back with fixed schemas.  Downstream steps (size probes, the
"nothing expanded" test, two uses of the same snapshot) then scan small
formatted tables instead of re-aggregating the raw tables, exactly as the
daily pipeline hands steps over through storage.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from popcorr.plans import combine, inputs
from popcorr.session import shared_dir
from popcorr.sources import layers, schemas
from popcorr.sources.testbed import RUN_DATE

SPECS = [
    # name, builder, (group, entity), schema, sort within files
    ("games", inputs.games, ("steam", "TopGames"), schemas.STEAM_FORMATTED, ["rank"]),
    ("streams", inputs.streams, ("twitch", "TopGames"), schemas.TWITCH_FORMATTED, ["rank"]),
    ("bars", inputs.bars, ("yahoo", "GamingStocks"), schemas.BARS_FORMATTED, ["ticker", "date"]),
    ("stream_map", inputs.stream_map, ("dims", "StreamNames"), schemas.STREAM_MAP, None),
]


def formatted_inputs(spark: SparkSession, sf_dir: str, root: str | None = None,
                     run_date: str = RUN_DATE, with_metrics: list | None = None) -> dict[str, DataFrame]:
    root = root or shared_dir(spark, "lake")
    # one aggregation of the order lines (the largest table) feeds both
    # snapshot lists; both writers run in the same thread, so the first fills
    # the cache with a single scan and the second reads it (no race, no
    # second scan); bars and the name map are written concurrently
    stats = inputs.part_stats(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    builders = {"games": lambda s, d: inputs.games(s, d, stats),
                "streams": lambda s, d: inputs.streams(s, d, stats)}
    by_name = {spec[0]: spec for spec in SPECS}
    lanes = [["games", "streams"], ["bars"], ["stream_map"]]

    def write(spec):
        name, build, (group, entity), schema, sort = spec
        path = layers.layer_path(root, "formatted", group, entity)
        meta = layers.write_layer(builders.get(name, build)(spark, sf_dir), path, run_date, sort,
                                  range_sorted=name == "bars", skip_empty=name in ("games", "streams"))
        return name, path, schema, (f"{group}/{entity}", meta["date"], meta["row_count"])

    def run_lane(names):
        return [write(by_name[n]) for n in names]

    try:
        with ThreadPoolExecutor(max_workers=len(lanes)) as pool:
            written = [w for lane in pool.map(run_lane, lanes) for w in lane]
    finally:
        stats.unpersist()
    order = {spec[0]: i for i, spec in enumerate(SPECS)}
    written.sort(key=lambda w: order[w[0]])
    out = {}
    for name, path, schema, meta in written:
        if with_metrics is not None:
            with_metrics.append(meta)
        out[name] = layers.read_optional(spark, path, schema, run_date)
    out["root"] = root
    return out


def usage_core(spark: SparkSession, sf_dir: str, jitter: bool = True,
               streams_present: bool = True) -> DataFrame:
    f = formatted_inputs(spark, sf_dir)
    streams = f["streams"] if streams_present else None
    return combine.combine(f["games"], f["bars"], streams, f["stream_map"], jitter=jitter)
