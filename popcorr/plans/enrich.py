"""Raw snapshot enrichment: ranking, ticker resolution, top stream per game.

W3/O3  top-N by a metric, 1-based rank (``operators.rank``)
J8     first-match ticker resolution (``popcorr.operators.resolve``)
J10/W4 viewer count of each game's top stream; 0 when the game has none
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A stream's place in the order - viewers, then the lowest order key, then the
# lowest line number - packed into one decimal (fixed widths of its parts).
_KEY_ROOM, _LINE_ROOM = Decimal(10) ** 18, Decimal(10) ** 4


def top_stream_per_game(games: DataFrame, streams: DataFrame) -> DataFrame:
    """Per game: its top stream (most viewers; ties -> lowest stream id) or 0 viewers.

    One scan of the streams (here: order lines of the part) and one hash
    aggregation: the order packed into a decimal is a type that hash
    aggregation updates in place, and the winner is read back from it.
    """
    key, line = F.col("l_orderkey").cast("decimal(18,0)"), F.col("l_linenumber").cast("decimal(4,0)")
    place = (((F.col("l_quantity").cast("long").cast("decimal(12,0)") * F.lit(_KEY_ROOM) + (F.lit(_KEY_ROOM - 1) - key)).cast("decimal(32,0)")
              * F.lit(_LINE_ROOM)).cast("decimal(38,0)") + (F.lit(_LINE_ROOM - 1) - line)).cast("decimal(38,0)")
    top = streams.groupBy("l_partkey").agg(F.max(place).alias("top"))
    digits = F.lpad(F.col("top").cast("string"), 38, "0")       # 16 of viewers, 18 of the key, 4 of the line
    top = top.select(
        "l_partkey", F.substring(digits, 1, 16).cast("long").alias("top_viewers"),
        F.concat_ws("-", (F.lit(10 ** 18 - 1) - F.substring(digits, 17, 18).cast("long")).cast("string"),
                    (F.lit(10 ** 4 - 1) - F.substring(digits, 35, 4).cast("long")).cast("string")).alias("top_stream"))
    return (games.select("game_id", F.col("game_id").cast("long").alias("l_partkey"))
                 .join(top, "l_partkey", "left")
                 .select("game_id", F.coalesce("top_viewers", F.lit(0).cast("long")).alias("top_viewers"),
                         "top_stream"))
