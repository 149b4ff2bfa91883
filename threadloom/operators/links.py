"""Links of stored pages and breadth-first reachability."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.constants import WS_BODY
from threadloom.functions.text import html_unescape
from threadloom.sources.stages import cut_lineage, path_exists

# The value with its quotes, if any; blanks may stand around the sign.
ANCHOR = (
    rf"(?i)<a[{WS_BODY}](?:[^>]*?[{WS_BODY}\"'])?href[{WS_BODY}]*=[{WS_BODY}]*"
    rf"(\"[^\"]*\"|'[^']*'|[^{WS_BODY}\"'>][^{WS_BODY}>]*)"
)


def site_root(url: Column) -> Column:
    """Scheme and host: everything before the third slash."""
    return F.substring_index(url, "/", 3)


def _unquoted(value: Column) -> Column:
    quoted = F.substring(value, 1, 1).isin('"', "'")
    return F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def extract_links(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Same-site links per page in document order, root-relative ones made absolute.

    Values may stand in double quotes, single quotes or none.
    """
    found = pages.select(
        id_col,
        F.col("url").alias("page_url"),
        site_root(F.col("url")).alias("_root"),
        F.posexplode(F.regexp_extract_all(F.col("html"), F.lit(ANCHOR), F.lit(1))).alias(
            "link_idx", "_raw"
        ),
    ).withColumn("_href", html_unescape(_unquoted(F.col("_raw"))))
    absolute = F.when(
        F.col("_href").startswith("/"), F.concat("_root", "_href")
    ).otherwise(F.col("_href"))
    return (
        found.withColumn("href", absolute)
        .where(F.col("href").startswith(F.col("_root")))
        .select(id_col, "page_url", "link_idx", "href")
    )


def crawl_frontier(
    edges: DataFrame, seeds: DataFrame, max_depth: int = 1, max_pages: int | None = None
) -> DataFrame:
    """``node, depth`` of everything reachable from ``seeds.node`` over ``edges.src -> dst``.

    One equi-join and one anti-join per level; each level is checkpointed so the
    plan stays flat and a lost executor costs no recomputation of older levels.
    The edges are read once per level, so derived ones should be staged first.
    ``max_pages`` keeps the nearest pages, in (depth, node) order.
    """
    frontier = cut_lineage(seeds.select("node").distinct().withColumn("depth", F.lit(0)))
    visited = frontier
    hops = edges.select(F.col("src"), F.col("dst"))
    reached = 0 if max_pages is None else frontier.count()
    for depth in range(1, max_depth + 1):
        if max_pages is not None and reached >= max_pages:
            break
        found = (
            frontier.join(hops, frontier["node"] == hops["src"])
            .select(F.col("dst").alias("node"))
            .distinct()
        )
        frontier = cut_lineage(
            found.join(visited, "node", "left_anti").withColumn("depth", F.lit(depth))
        )
        if frontier.isEmpty():
            break
        reached += 0 if max_pages is None else frontier.count()
        visited = visited.unionByName(frontier)
    if max_pages is None:
        return visited
    return visited.orderBy("depth", "node").limit(max_pages)


def crawl_stored(
    edges: DataFrame, seeds: DataFrame, path: str, max_depth: int = 1, ranges: int = 64
) -> DataFrame:
    """``crawl_frontier`` whose levels are stored under ``path`` and can be continued.

    Level d is one Parquet table split into ``ranges`` hash ranges of the node. A call goes on
    after the last finished level, so a stopped crawl is repeated with the same arguments and
    a finished one goes deeper with a larger ``max_depth``; a half-written level is replaced.
    New nodes are compared only with those hash ranges of older levels that they fall into,
    so that a small late level does not read the whole visited set. Null is no node.
    """
    spark = edges.sparkSession
    place = F.pmod(F.xxhash64("node"), F.lit(ranges)).cast("int")

    def level(depth: int) -> str:
        return f"{path}/depth={depth}"

    def finished(depth: int) -> bool:
        return path_exists(spark, f"{level(depth)}/_SUCCESS")

    def read(depth: int) -> DataFrame:
        shape = f"node {seeds.schema['node'].dataType.simpleString()}, range int"
        return spark.read.schema(shape).parquet(level(depth))

    def known_before(depth: int, touched: list[int]) -> DataFrame:
        known = reduce(DataFrame.unionByName, [read(d) for d in range(depth)])
        return known.where(F.col("range").isin(touched)).select("node")

    def store(nodes: DataFrame, depth: int) -> None:
        # A level is clustered by range first: one file per range and not per task and range.
        nodes.withColumn("range", place).repartition("range").write.mode("overwrite").partitionBy("range").parquet(level(depth))

    if not finished(0):
        store(seeds.select("node").dropna().distinct(), 0)
    hops = edges.select("src", "dst").dropna()
    depth = 0
    while depth < max_depth and finished(depth + 1):
        depth += 1
    while depth < max_depth and not read(depth).isEmpty():
        frontier = read(depth)
        found = cut_lineage(
            frontier.join(hops, frontier["node"] == hops["src"]).select(F.col("dst").alias("node")).distinct()
        )
        touched = [r[0] for r in found.select(place).distinct().collect()]
        depth += 1
        store(found.join(known_before(depth, touched), "node", "left_anti"), depth)
    levels = [read(d).select("node", F.lit(d).alias("depth")) for d in range(depth + 1)]
    return reduce(DataFrame.unionByName, levels)
