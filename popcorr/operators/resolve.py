"""Entity -> ticker resolution by an ordered first-match rule.

For the publisher, then the developer of a snapshot row (empty/NULL names are
skipped):
  (a) a case-sensitive exact key hit whose ticker is not NULL wins;
  (b) otherwise the first map entry (by ``ordinal``) where either string
      contains the other, case-insensitively - its ticker is returned even
      when it is NULL, and the developer is then not tried;
  no hit for either name -> NULL.

Spark plan: the *distinct* names (not the rows) meet the map in two equi-joins.
A string that another contains has all its short substrings in it, so the
contained one is indexed by its first ``GRAM`` letters (fewer if it is
shorter) and the containing one by all its substrings of 0 to ``GRAM`` letters; the
``contains`` test then runs on those candidates only.  A hash ``min`` over
(priority, ordinal) packed into one long picks the first match per name, and
the per-name result is equi-joined back to the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Letters of an index key of the substring test.
GRAM = 4

# priority (0 = exact hit with a ticker, 1 = substring hit) and map ordinal
# packed into one long, so the first-match pick is a hash aggregation (min)
_PRIORITY_SHIFT = 1 << 32


def _head(c: str) -> F.Column:
    """The key under which a contained string is indexed: its first letters."""
    return F.substring(c, 1, GRAM)


def _grams(c: str) -> F.Column:
    """All distinct substrings of 0 to GRAM letters of a string."""
    places = F.sequence(F.lit(1), F.greatest(F.char_length(c), F.lit(1)))
    cut = lambda k: F.transform(places, lambda i: F.substr(F.col(c), i, F.lit(k)))
    return F.array_distinct(F.flatten(F.array(*[cut(k) for k in range(GRAM + 1)])))


def name_matches(names: DataFrame, mapping: DataFrame) -> DataFrame:
    """Per distinct name: ``hit`` (bool) and the first-match ``ticker``."""
    m = mapping.select("ordinal", "k", F.col("ticker").alias("m_ticker"), F.lower("k").alias("k_lower"))
    n = names.select("nm", F.lower("nm").alias("nl"))
    inside_name = (n.withColumn("g", F.explode(_grams("nl")))
                    .join(m.withColumn("g", _head("k_lower")), "g").where(F.contains("nl", "k_lower")))
    inside_key = (n.withColumn("g", _head("nl"))
                   .join(m.withColumn("g", F.explode(_grams("k_lower"))), "g").where(F.contains("k_lower", "nl")))
    cols = ["nm", "k", "m_ticker", "ordinal"]
    exact = (F.col("nm") == F.col("k")) & F.col("m_ticker").isNotNull()
    code = F.when(exact, 0).otherwise(1).cast("long") * F.lit(_PRIORITY_SHIFT) + F.col("ordinal")
    best = (inside_name.select(*cols).unionByName(inside_key.select(*cols))
                 .groupBy("nm").agg(F.min(code).alias("code"))
                 .withColumn("ordinal", (F.col("code") % F.lit(_PRIORITY_SHIFT)).cast("int")))
    return (best.join(m.select("ordinal", "m_ticker"), "ordinal", "inner")
                .select("nm", F.lit(True).alias("hit"), F.col("m_ticker").alias("ticker")))


def resolve_ticker(df: DataFrame, mapping: DataFrame, publisher: str = "publisher",
                   developer: str = "developer", out: str = "ticker") -> DataFrame:
    """Add (or replace) ``out`` with the first-match ticker of publisher, then developer."""
    usable = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    names = (df.where(usable(publisher)).select(F.col(publisher).alias("nm"))
             .union(df.where(usable(developer)).select(F.col(developer).alias("nm")))
             .distinct())
    res = name_matches(names, mapping)
    pub = res.select(F.col("nm").alias("_pub"), F.col("hit").alias("_pub_hit"),
                     F.col("ticker").alias("_pub_ticker"))
    dev = res.select(F.col("nm").alias("_dev"), F.col("hit").alias("_dev_hit"),
                     F.col("ticker").alias("_dev_ticker"))
    joined = (df.join(pub, F.col(publisher) == F.col("_pub"), "left")
                .join(dev, F.col(developer) == F.col("_dev"), "left"))
    ticker = (F.when(F.col("_pub_hit"), F.col("_pub_ticker"))
              .when(F.col("_dev_hit"), F.col("_dev_ticker")))
    cols = [ticker.alias(out) if c == out else F.col(c) for c in df.columns]
    if out not in df.columns:
        cols.append(ticker.alias(out))
    return joined.select(*cols)
