"""Raw lists that come in pages with a cursor.

A page is one JSON line: its own cursor (none for the first page), its records
and the cursor of the page after it.  ``follow`` reads pages as a client would
fetch them: from the first page on, page after page by its cursor, until a page
is empty, has no cursor, or the page limit is reached; pages beyond that are not
read into the result.  The walk is a recursive query over the page heads
(cursor, next cursor, number of records); records join its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: records of a page, pages fetched at most
PAGE_RECORDS, MAX_PAGES = 50, 6

_WALK = """
WITH RECURSIVE walk AS (
  SELECT list, cursor, next_cursor, records, 1 AS page FROM {heads} WHERE cursor IS NULL
  UNION ALL
  SELECT h.list, h.cursor, h.next_cursor, h.records, w.page + 1
  FROM walk w JOIN {heads} h ON h.list = w.list AND h.cursor = w.next_cursor
  WHERE w.records > 0 AND w.page < {pages})
SELECT list, cursor, page FROM walk WHERE records > 0"""


def paginate(records: DataFrame, page: str, names: list[str], list_col: str = "list") -> DataFrame:
    """(list, cursor, data, next_cursor) of records numbered by ``page`` from 1; a page with null records keeps its cursors.

    A page's records are bounded by the page size, so a list of them is too.
    """
    given = F.when(F.col(names[0]).isNotNull(), F.struct(*names))
    rows = records.groupBy(list_col, page).agg(F.collect_list(given).alias("data"))
    after = F.max(page).over(_by_list(list_col))
    name = lambda p: F.concat(F.lit("p"), p.cast("string"))
    return rows.select(F.col(list_col).alias("list"), F.when(F.col(page) > 1, name(F.col(page))).alias("cursor"), "data",
                       F.when(F.col(page) < after, name(F.col(page) + 1)).alias("next_cursor"))


def _by_list(list_col: str):
    from pyspark.sql import Window

    return Window.partitionBy(list_col)             # page heads of one list


def write_pages(pages: DataFrame, path: str) -> None:
    pages.write.json(path)


def read_pages(spark: SparkSession, path: str, record_schema: str) -> DataFrame:
    return spark.read.schema(f"list string, cursor string, data array<struct<{record_schema}>>, next_cursor string").json(path)


def follow(pages: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """The records of all pages that are reached, with their list and page number."""
    heads = pages.select("list", "cursor", "next_cursor", F.coalesce(F.size("data"), F.lit(0)).alias("records"))
    reached = pages.sparkSession.sql(_WALK.replace("{pages}", str(int(max_pages))), heads=heads)
    same = pages["list"].eqNullSafe(reached["list"]) & pages["cursor"].eqNullSafe(reached["cursor"])
    return pages.join(reached, same).select(pages["list"], "page", F.inline("data"))
