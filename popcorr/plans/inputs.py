"""Formatted inputs built from the driver tables of one scale directory.

    raw games   = parts by quantity -> ticker resolution (enrich) -> format
    raw streams = parts by revenue -> format
    raw bars    = events per (type, day) -> format
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from popcorr.operators.resolve import resolve_ticker
from popcorr.plans import formats
from popcorr.sources import testbed


def enrich_snapshot(raw_games: DataFrame, publisher_map: DataFrame) -> DataFrame:
    """Raw game records with missing-key defaults and the first-match ticker."""
    return resolve_ticker(formats.null_defaults_games(raw_games), publisher_map)


def part_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.part_stats(testbed.read(spark, sf_dir, "lineitem"),
                              testbed.read(spark, sf_dir, "part"))


def raw_games(spark: SparkSession, sf_dir: str, stats: DataFrame | None = None, n: int | None = None) -> DataFrame:
    """Raw game records of all parts, or of the first ``n`` by rank."""
    stats = stats if stats is not None else part_stats(spark, sf_dir)
    return enrich_snapshot(testbed.raw_games(stats, n), testbed.publisher_map(spark))


def raw_streams(spark: SparkSession, sf_dir: str, stats: DataFrame | None = None, n: int | None = None) -> DataFrame:
    stats = stats if stats is not None else part_stats(spark, sf_dir)
    return testbed.raw_streams(stats, n)


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.raw_bars(testbed.read(spark, sf_dir, "events"))


def games(spark: SparkSession, sf_dir: str, stats: DataFrame | None = None) -> DataFrame:
    return formats.format_steam(raw_games(spark, sf_dir, stats))


def streams(spark: SparkSession, sf_dir: str, stats: DataFrame | None = None) -> DataFrame:
    return formats.format_twitch(raw_streams(spark, sf_dir, stats))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.format_bars(raw_bars(spark, sf_dir))


def stream_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.stream_map(testbed.read(spark, sf_dir, "part"))
