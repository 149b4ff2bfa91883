"""Registered queries: image augmentation, links and reachability."""

from pyspark.sql import Column, functions as F

from threadloom.operators import images as im, links
from threadloom.plans.registry import register
from threadloom.plans.views import RASTERS_SQL, SEED, q, rasters, sql_unescape, table
from threadloom.sources import images as image_io, stages

_VARIANTS = "('bright'), ('contrast'), ('rotated'), ('flipped'), ('cropped')"


def _draw(what: str) -> str:
    key = f"concat(origin, ':', aug, ':{what}:{SEED}')"
    return f"(CAST(concat('0x', substring(md5({key}), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


# Sizes of these rasters are 8 x 8, so the crop side is floor(0.8 * 8) = 6.
_PARAMS_SQL = f"""{RASTERS_SQL},
params AS (
  SELECT origin, aug, px,
    CASE WHEN aug IN ('bright', 'contrast') THEN round({_draw("factor")} * 0.9::DOUBLE + 0.5, 6) END AS factor,
    CASE WHEN aug = 'rotated' THEN round({_draw("angle")} * 90.0::DOUBLE - 45.0, 6) END AS angle,
    CASE WHEN aug = 'cropped' THEN 6 END AS size,
    CASE WHEN aug = 'cropped' THEN CAST(floor({_draw("left")} * 3) AS INTEGER) END AS left_at,
    CASE WHEN aug = 'cropped' THEN CAST(floor({_draw("top")} * 3) AS INTEGER) END AS top_at
  FROM rasters CROSS JOIN (VALUES {_VARIANTS}) v(aug))"""


@register(
    "augment_params",
    f"WITH {_PARAMS_SQL} SELECT origin, aug, factor, angle, size, left_at, top_at FROM params",
)
def augment_params_query(spark, d):
    plan = im.augment_params(rasters(spark, d), SEED)
    return plan.select(
        "origin", "aug", "factor", "angle", "size", F.col("left").alias("left_at"), F.col("top").alias("top_at")
    )


def pixel_text(data: Column) -> Column:
    """Bytes as upper-case hex."""
    return F.hex(data)


_HEX = "array_to_string(list_transform({px}, lambda v: lpad(printf('%X', v), 2, '0')), '')"
_CLIP = "CAST(greatest(least(floor({v} + 0.5), 255), 0) AS INTEGER)"
_PIXELS_SQL = f"""{_PARAMS_SQL},
sized AS (
  SELECT *, cos(radians(angle)) AS c, sin(radians(angle)) AS s, floor(list_avg(px) + 0.5) AS mid FROM params),
canvas AS (
  SELECT *, CASE WHEN aug = 'rotated' THEN CAST(ceil(round(8 * abs(c) + 8 * abs(s), 6)) AS INTEGER) ELSE 8 END AS side FROM sized),
variants AS (
  SELECT origin, aug, side, CASE aug
    WHEN 'bright' THEN list_transform(px, lambda v: {_CLIP.format(v="v * factor")})
    WHEN 'contrast' THEN list_transform(px, lambda v: {_CLIP.format(v="mid + factor * (v - mid)")})
    WHEN 'flipped' THEN list_transform(range(64), lambda i: px[(i // 8) * 8 + 7 - i % 8 + 1])
    WHEN 'cropped' THEN list_transform(range(64), lambda i:
      px[(top_at + (i // 8) * 6 // 8) * 8 + left_at + (i % 8) * 6 // 8 + 1])
    ELSE list_transform(
      list_transform(range(side * side), lambda i: [
        CAST(floor(round(c * (i % side + 0.5 - side / 2) - s * (i // side + 0.5 - side / 2) + 4, 6)) AS INTEGER),
        CAST(floor(round(s * (i % side + 0.5 - side / 2) + c * (i // side + 0.5 - side / 2) + 4, 6)) AS INTEGER)]),
      lambda p: CASE WHEN p[1] BETWEEN 0 AND 7 AND p[2] BETWEEN 0 AND 7 THEN px[p[2] * 8 + p[1] + 1] ELSE 0 END)
    END AS out FROM canvas
  UNION ALL SELECT origin, 'original', 8, px FROM rasters)"""


@register(
    "augment_images",
    f"""WITH {_PIXELS_SQL} SELECT origin, aug, CAST(side AS INTEGER) AS width, CAST(side AS INTEGER) AS height,
        {_HEX.format(px="out")} AS pixels FROM variants""",
)
def augment_images_query(spark, d):
    return im.augment_images(rasters(spark, d), SEED).select(
        "origin", "aug", "width", "height", pixel_text(F.col("data")).alias("pixels")
    )


@register(
    "sink_images",
    f"""WITH {RASTERS_SQL} SELECT CASE WHEN aug = 'original' THEN replace(origin, 'img/', '')
        ELSE concat(replace(replace(origin, 'img/', ''), '.png', ''), '_', aug, '.png') END AS out_name
        FROM rasters CROSS JOIN (VALUES {_VARIANTS}, ('original')) v(aug)""",
)
def sink_images_query(spark, d):
    path = stages.scratch_path(spark, "variants")
    image_io.sink_images(im.augment_images(rasters(spark, d), SEED), path)
    return spark.read.parquet(path).select("out_name")


@register(
    "scan_images",
    f"""WITH {RASTERS_SQL} SELECT replace(origin, 'img/', '') AS name, 8 AS height, 8 AS width,
        {_HEX.format(px="px")} AS pixels FROM rasters""",
)
def scan_images_query(spark, d):
    path = stages.scratch_path(spark, "images")
    named = rasters(spark, d).withColumn(
        "out_name", image_io.variant_name(F.col("origin"), F.lit("original"))
    )
    image_io.export_png(named, path)
    return image_io.scan_images(spark, path).select(
        F.element_at(F.split("origin", "/"), -1).alias("name"), "height", "width", pixel_text(F.col("data")).alias("pixels")
    )


# --- links ---------------------------------------------------------------------------
_QUOTES = "\"'"
_ANCHOR_SQL = r"""(?i)<a\s(?:[^>]*?[\s"'])?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
_LINKS_SQL = f"""found AS (
  SELECT page_id, url, array_to_string(string_split(url, '/')[1:3], '/') AS root,
         list_transform(regexp_extract_all(html, {q(_ANCHOR_SQL)}, 1), lambda v: trim(v, {q(_QUOTES)})) AS hs FROM pages),
raw_links AS (
  SELECT page_id, url, root, CAST(i - 1 AS INTEGER) AS link_idx, {sql_unescape("hs[i]")} AS h
  FROM (SELECT *, unnest(range(1, len(hs) + 1)) AS i FROM found)),
links AS (
  SELECT page_id, url AS page_url, link_idx, href FROM (
    SELECT *, CASE WHEN h LIKE '/%' THEN concat(root, h) ELSE h END AS href FROM raw_links)
  WHERE starts_with(href, root))"""


@register("extract_links", f"WITH {_LINKS_SQL} SELECT page_id, page_url, link_idx, href FROM links")
def extract_links_query(spark, d):
    return links.extract_links(table(spark, d, "pages"))


_EDGES_SQL = f"""{_LINKS_SQL}, sizes AS (SELECT count(*) AS n FROM pages),
hops AS (
  SELECT page_id, (page_id * 7 + 3) % n AS target FROM pages, sizes
  UNION ALL SELECT page_id, (page_id * 3 + 1) % n FROM pages, sizes),
edges AS (
  SELECT a.url AS src, b.url AS dst FROM hops JOIN pages a ON a.page_id = hops.page_id JOIN pages b ON b.page_id = target
  UNION ALL SELECT page_url, href FROM links),
reached AS (
  SELECT arg_min(url, page_id) AS node, 0 AS depth FROM pages
  UNION SELECT dst, depth + 1 FROM reached JOIN edges ON src = node WHERE depth < 6)"""


_REACHED_SQL = f"WITH RECURSIVE {_EDGES_SQL} SELECT node, min(depth) AS depth FROM reached GROUP BY node"


def page_graph(spark, d):
    """Page-to-page hops and extracted links, and the first page."""
    pages = table(spark, d, "pages")
    size = pages.agg(F.count(F.lit(1))).scalar()
    page = F.col("page_id")
    hops = pages.select(
        F.col("url").alias("src"),
        F.explode(F.array((page * 7 + 3) % size, (page * 3 + 1) % size)).alias("target"),
    )
    targets = pages.select(F.col("page_id").alias("target"), F.col("url").alias("dst"))
    edges = hops.join(targets, "target").select("src", "dst").unionByName(
        links.extract_links(pages).select(F.col("page_url").alias("src"), F.col("href").alias("dst"))
    )
    return stages.cut_lineage(edges), pages.agg(F.min_by("url", "page_id").alias("node"))


@register("crawl_frontier", _REACHED_SQL)
def crawl_frontier_query(spark, d):
    """Six levels out of the first page, over page-to-page hops and extracted links."""
    return links.crawl_frontier(*page_graph(spark, d), max_depth=6)


_SITES_SQL = _EDGES_SQL[: _EDGES_SQL.index("reached AS")] + """reached AS (
  SELECT arg_min(url, page_id) AS node, 0 AS depth FROM pages GROUP BY array_to_string(string_split(url, '/')[1:3], '/')
  UNION SELECT dst, depth + 1 FROM reached JOIN edges ON src = node WHERE depth < 12)"""


@register(
    "crawl_stored",
    f"WITH RECURSIVE {_SITES_SQL} SELECT node, min(depth) AS depth FROM reached WHERE node IS NOT NULL GROUP BY node",
)
def crawl_stored_query(spark, d):
    """Twelve stored levels out of the first page of every site, in two calls."""
    edges, _ = page_graph(spark, d)
    first = F.min_by("url", "page_id").alias("node")
    seeds = table(spark, d, "pages").groupBy(links.site_root(F.col("url"))).agg(first)
    path = stages.scratch_path(spark, "crawl")
    links.crawl_stored(edges, seeds, path, max_depth=5)
    return links.crawl_stored(edges, seeds, path, max_depth=12)
