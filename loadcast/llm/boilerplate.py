"""Line dedup by site-relative frequency, in DataFrame operations only.

Rows are grouped by site; a line's frequency is the number of the site's pages that contain it over the site's
pages; copies of a page are one page. Lines above a ratio are boilerplate and go from every page of the site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, same, text_of, whole_row

RATIO = 0.05  # of the site's pages
LEAST_PAGES = 2  # different ones that contain a line before it can go: once it repeats at all, the ratio decides


def line_hashes(text: Column) -> Column:
    """A hash per line of a text, of the line without its outer blanks; null for a blank line, which never counts."""

    def of(line):
        bare = F.trim(line, F.lit(" \t\r"))
        return F.when(bare != "", F.xxhash64(bare))

    return F.transform(F.split(text, "\n", -1), of)


def site_lines(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Boilerplate of ``pages`` (site, hashes): site, line, pages, site_pages.

    Pages of one site with the same set of lines are one page, so that copies of a document don't make its lines
    frequent. Every page adds each of its distinct lines once, as a hash, so the shuffles carry hashes, no text.
    """
    lines = F.sort_array(F.array_distinct(F.array_compact("hashes")))
    pages = pages.select("site", lines.alias("hashes")).distinct()
    counted = (
        pages.select("site", F.explode("hashes").alias("line"))
        .groupBy("site", "line").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least_pages)
    )
    sites = pages.groupBy("site").agg(F.count(F.lit(1)).alias("site_pages"))
    joined = counted.join(sites, same(counted, sites, ["site"])).drop(sites["site"])
    return joined.where(F.col("pages") > ratio * F.col("site_pages"))


def drop_boilerplate(
    docs: DataFrame, site: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES, counts: str = "lines"
) -> DataFrame:
    """``docs`` with boilerplate lines gone from ``text``, plus a struct (total, dropped) of lines, named by ``counts``.

    All rows stay, a page of nothing but boilerplate with an empty text; kept lines keep their order, blank lines stay.
    A null text stays null and counts as a page without lines; null is a site of its own. Pages of the same lines count
    as one page, and a line goes from ``least_pages`` such pages on, if they exceed the ratio. Repeated rows get the same
    text. A line is compared whole, without outer blanks. An empty table gives no rows. Columns of any name pass through.

    The text is read twice and shuffled once: line hashes are kept from the first pass, and pages whose lines met
    boilerplate get the positions to leave out in the second.
    """
    text = text_of()
    site_name = F.col(f"`{site}`").cast("string")
    # 128 bits of site and text: rows alike in both lose the same lines.
    key = [F.xxhash64(text, site_name).alias("key1"), F.xxhash64(F.lit(1), text, site_name).alias("key2")]
    pages = keep(docs.select(site_name.alias("site"), *key, line_hashes(text).alias("hashes")), "site-pages")
    common = keep(site_lines(pages, ratio, least_pages).select("site", "line"), "site-lines")
    placed = pages.select("site", "key1", "key2", F.posexplode("hashes").alias("at", "line")).where(F.col("line").isNotNull())
    met = placed.join(common, same(placed, common, ["site", "line"]), "left_semi")
    gone = met.groupBy(F.col("key1").alias("gone1"), F.col("key2").alias("gone2")).agg(F.sort_array(F.collect_set("at")).alias("gone"))
    whole = docs.select(whole_row(docs), *key, F.split(F.col("text").cast("string"), "\n", -1).alias("lines"))
    joined = whole.join(gone, (F.col("key1") == F.col("gone1")) & (F.col("key2") == F.col("gone2")), "left")
    # Runs between the positions to leave out; each run is one slice.
    left = F.concat(F.array(F.lit(-1)), F.col("gone"))
    right = F.concat(F.col("gone"), F.array(F.size("lines")))
    runs = F.zip_with(left, right, lambda a, b: F.slice(F.col("lines"), a + F.lit(2), b - a - F.lit(1)))
    kept = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(F.flatten(runs), "\n"))
    count = lambda c: F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.size(c)).cast("long")
    columns = [kept.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return joined.select(*columns, F.struct(count("lines").alias("total"), count("gone").alias("dropped")).alias(counts))
