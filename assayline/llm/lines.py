"""Lines that many sites share, found by the spread of each line over distinct sites.

A line counts by its normal form: leading and trailing white space off, inner runs as one
blank. Lines are hashed once. A line that does not occur more often than the threshold cannot be on
more sites, so a plain count leaves the others. Their sites are counted in a sketch
(HyperLogLog) per line hash; sketches of parts merge by aggregation. Where the estimate is so
near the threshold that the sketch may be wrong, the sites are counted exactly. Only built-in
functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import stored

#: Fixed production parameters: sites a line may be on at most, and log2 of sketch registers.
MAX_SITES = 10
LG_K = 10
#: Fixed: tags after which a line ends in HTML.
BLOCK_END = r"(?i)</(?:p|div|li|ul|nav|article|header|footer|h[1-6]|tr|table|title|head|script|style|body|html)>|<br ?/?>"

#: Runs of white space within a line that are not one blank already.
RUN = r"\x20[\x20\x09\x0B-\x0D]+|[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*"


def host(url: Column) -> Column:
    """Site of an address: the lower-cased part after `//`, without user and port."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^/?#]*//([^/?#@]*@)?([^/?#:]*)", 2))


def with_ends(text: Column) -> Column:
    """The text with line ends; tags that end a block end a line too, so that HTML without
    line ends has lines."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLOCK_END, "$0\n")


def hashes_of(text: Column) -> Column:
    """Hash of the normal form of each line of a text with line ends; null for blank lines."""
    lines = F.split(F.regexp_replace(text, RUN, " "), "\n", -1)
    return F.transform(lines, lambda x: F.unhex(F.md5(F.nullif(F.trim(x), F.lit("")))))


def spread_lines(lines: DataFrame, max_sites: int = MAX_SITES, lg_k: int = LG_K,
                 sigmas: float = 6.0) -> DataFrame:
    """Hashes of lines on more than `max_sites` sites: (line, sites), from (line, site).

    Two levels: sketches per line and slice of sites first, so that a line in a third of all
    rows is counted by many tasks; then they merge. `sites` is the estimate, exact near
    the threshold. Rows with null are left out.
    """
    error = sigmas * 1.04 / math.sqrt(1 << lg_k)
    part = lines.dropna().groupBy("line", F.pmod(F.xxhash64("site"), F.lit(16)).alias("slice")) \
        .agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
    sketched = stored(
        part.groupBy("line").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("sites"))
        .where(F.col("sites") * (1 + error) + 1 > max_sites), "line-spread")
    low, high = max_sites * (1 - error) - 1, max_sites * (1 + error) + 1
    near = sketched.where(F.col("sites").between(low, high)).select("line")
    exact = lines.dropna().join(near, "line").distinct().groupBy("line") \
        .agg(F.count("*").alias("sites")).where(F.col("sites") > max_sites)
    return sketched.where(F.col("sites") > high).unionByName(exact)


def without_spread_lines(pages: DataFrame, id_col: str = "page_id", text_col: str = "html",
                         site: Column | None = None, max_sites: int = MAX_SITES,
                         lg_k: int = LG_K) -> DataFrame:
    """A row per page: page_id, n_lines, n_removed, removed (line numbers from 0), kept (text).

    Lines on more than `max_sites` distinct sites go, except blank ones. A null text is empty
    and has one blank line; a page without a site (null or unreadable address) counts for the
    site ''. Rows that share an id are told apart by a row number. Columns other than id, text
    and address are not read. An empty table gives no rows.
    """
    site = host(F.col("url")) if site is None else F.coalesce(site, F.lit(""))
    base = stored(pages.select(F.col(id_col).alias("page_id"), site.alias("site"),
                               with_ends(F.col(text_col)).alias("text"))
                  .select("page_id", "site", F.split("text", "\n", -1).alias("lines"),
                          hashes_of(F.col("text")).alias("hashes"),
                          F.monotonically_increasing_id().alias("row")), "line-pages")
    flat = base.select("row", "site", F.posexplode("hashes").alias("pos", "line")).where("line is not null")
    often = stored(flat.groupBy("line").count().where(F.col("count") > max_sites).select("line"), "line-often")
    seen = stored(flat.join(often, "line"), "line-seen")
    spread = stored(spread_lines(seen.select("line", "site"), max_sites, lg_k), "line-boilerplate")
    removed = seen.join(spread.select("line"), "line").groupBy("row") \
        .agg(F.sort_array(F.collect_list("pos")).alias("removed"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1),
                          F.coalesce("removed", F.array().cast("array<int>")))
    return base.join(removed, "row", "left").select(
        "page_id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        F.array_join(F.transform(left, lambda i: F.col("lines")[i]), "\n").alias("kept"))
