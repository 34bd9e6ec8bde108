"""Line dedup by distinct-site spread: boilerplate that many sites share goes.

A line is what stands between line feeds, less blanks around it; blank lines
are not counted and stay. One hash aggregation finds the lines seen on two
sites at least; a line of one site cannot be boilerplate. Over the rest,
HyperLogLog sketches of the sites merge by aggregation, one for each line hash.
Where a sketch's estimate is so near the threshold that its error could decide,
the line's distinct sites are counted exactly. Lines of ``sites`` sites or more
are taken out of every document.

Everything is DataFrame functions. Lines are compared by 64-bit hashes.

Defined results: null and empty texts have no lines; a document without a site
(null) adds none to its lines' spread but loses the same lines; documents are
told apart by id and text, so repeated rows and rows without an id are handled
alike; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import BLANKS, beside, quoted, staged, text_of

LG_K = 12
#: So many line hashes go to every task; more are joined by shuffle.
_FEW = 1 << 20


def bare(line: Column) -> Column:
    return F.trim(line, F.lit(BLANKS))


def spread_lines(docs: DataFrame, sites: int, text_col: str, site_col: str) -> DataFrame:
    """Hashes of the lines that ``sites`` distinct sites have at least."""
    lines = docs.select(
        F.xxhash64(F.col(quoted(site_col)).cast("string")).alias("site"), F.col(quoted(site_col)).isNotNull().alias("known"),
        F.explode(F.split(text_of(text_col), "\n")).alias("line"),
    ).filter("known").select("site", bare(F.col("line")).alias("line")).filter("line <> ''")
    hashed = lines.select(F.xxhash64("line").alias("line"), "site")
    several = staged(
        hashed.groupBy("line").agg(F.min("site").alias("a"), F.max("site").alias("b")).filter("a < b").select("line"), "lines"
    )
    if several.count() <= _FEW:
        pairs = hashed.join(F.broadcast(several), "line", "left_semi")
    else:  # the rows of a frequent line are first reduced to one for each site
        pairs = hashed.distinct().join(several, "line", "left_semi")
    estimated = pairs.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("spread"))
    # Four standard errors, and rounding.
    band = 1 + 4 * 1.04 / math.sqrt(1 << LG_K) * sites
    estimated = staged(estimated, "spreads")
    sure = estimated.filter(F.col("spread") > sites + band).select("line")
    near = estimated.filter(F.abs(F.col("spread") - sites) <= band).select("line")
    counted = pairs.join(near, "line", "left_semi").distinct().groupBy("line").agg(F.count("*").alias("n"))
    return staged(sure.unionByName(counted.filter(F.col("n") >= sites).select("line")), "spread-lines")


def line_dedup(docs: DataFrame, sites: int = 5, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """(row, n_lines, n_removed, kept_text) of every row; ``row`` has its columns."""
    found = spread_lines(docs, sites, text_col, site_col)
    text = text_of(text_col)
    own = docs.select(F.col(quoted(id_col)).alias("id"), F.xxhash64(text).alias("mark"), F.explode(F.split(text, "\n")).alias("line"))
    hits = beside(own.select("id", "mark", F.xxhash64(bare(F.col("line"))).alias("line")), found, ["line"], "left_semi")
    by_doc = hits.groupBy("id", "mark").agg(F.collect_set("line").alias("gone"))
    whole = docs.select(
        F.struct(*(F.col(quoted(c)) for c in docs.columns if c != text_col)).alias("row"), F.col(quoted(id_col)).alias("own_id"),
        text.alias("text"), F.xxhash64(text).alias("own_mark"),
    )
    joined = whole.join(by_doc, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_mark") == F.col("mark")), "left")
    lines = F.split("text", "\n")
    kept = F.when(F.col("gone").isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~F.array_contains("gone", F.xxhash64(bare(x))))
    )
    filled = F.size(F.filter(lines, lambda x: bare(x) != "")).cast("long")
    return joined.select(
        "row", filled.alias("n_lines"), (F.size(lines) - F.size(kept)).cast("long").alias("n_removed"),
        F.array_join(kept, "\n").alias("kept_text"),
    )
