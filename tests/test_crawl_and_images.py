"""Stored crawls that go on after a stop, and the plans and names of image jobs."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from threadloom.operators import images as im, links
from threadloom.schemas import IMAGE
from threadloom.sources import images as image_io


def walked(edges, seeds, depth):
    seen, level = {s: 0 for s in seeds}, set(seeds)
    for d in range(1, depth + 1):
        level = {b for a, b in edges if a in level and b is not None} - set(seen)
        seen.update({n: d for n in level})
    return seen


@pytest.fixture(scope="module")
def graph(spark):
    rng = random.Random(2)
    pairs = [(f"n{rng.randrange(200)}", f"n{rng.randrange(200)}") for _ in range(300)] + [("n1", None), (None, "n2")]
    edges = spark.createDataFrame(pairs, "src string, dst string")
    seeds = spark.createDataFrame([("n1",), ("n1",), (None,)], "node string")
    return pairs, edges, seeds


def levels(df):
    rows = df.collect()
    assert len({r["node"] for r in rows}) == len(rows)
    return {r["node"]: r["depth"] for r in rows}


def test_stored_crawl_goes_on_after_a_stop(spark, graph, tmp_path):
    pairs, edges, seeds = graph
    path = str(tmp_path / "crawl")
    assert levels(links.crawl_stored(edges, seeds, path, max_depth=2, ranges=8)) == walked(pairs, ["n1"], 2)
    # A level without its marker was left half-written; the marker of an older one stays as it is.
    marker = Path(path) / "depth=2" / "_SUCCESS"
    marker.rename(tmp_path / "taken")
    older = (Path(path) / "depth=1" / "_SUCCESS").stat().st_mtime_ns
    assert levels(links.crawl_stored(edges, seeds, path, max_depth=9, ranges=8)) == walked(pairs, ["n1"], 9)
    assert (Path(path) / "depth=1" / "_SUCCESS").stat().st_mtime_ns == older and marker.exists()
    # A finished crawl needs no edges any more.
    assert levels(links.crawl_stored(edges.limit(0), seeds, path, max_depth=9, ranges=8)) == walked(pairs, ["n1"], 9)


def test_stored_crawl_equals_the_plain_one_and_ends(spark, graph, tmp_path):
    pairs, edges, seeds = graph
    path = str(tmp_path / "crawl")
    got = levels(links.crawl_stored(edges, seeds, path, max_depth=500, ranges=4))
    assert got == walked(pairs, ["n1"], 500)
    assert len(list(Path(path).iterdir())) < 60
    empty = links.crawl_stored(edges, seeds.limit(0), str(tmp_path / "none"), max_depth=3)
    assert empty.count() == 0 and empty.columns == ["node", "depth"]


def test_a_level_reads_only_touched_ranges(spark, graph, tmp_path):
    """Files of ranges that no new node falls into can be broken without harm."""
    pairs, edges, seeds = graph
    path = tmp_path / "crawl"
    links.crawl_stored(edges, seeds, str(path), max_depth=2, ranges=64)
    frontier = [n for n, d in walked(pairs, ["n1"], 2).items() if d == 2]
    new = spark.createDataFrame([(b,) for a, b in pairs if a in frontier and b], "node string")
    touched = {f"range={r[0]}" for r in new.select(F.pmod(F.xxhash64("node"), F.lit(64))).distinct().collect()}
    broken = 0
    for part in path.glob("depth=[01]/range=*/*.parquet"):
        if part.parent.name not in touched:
            part.write_bytes(b"broken")
            broken += 1
    assert broken and touched
    links.crawl_stored(edges, seeds, str(path), max_depth=3, ranges=64)
    stored = {r["node"] for r in spark.read.parquet(str(path / "depth=3")).collect()}
    assert stored == {n for n, d in walked(pairs, ["n1"], 3).items() if d == 3}


def one_image(origin):
    return (origin, 2, 2, 3, 16, bytes(range(12)))


def test_pixels_travel_once(spark):
    images = spark.createDataFrame([one_image("a.png"), one_image("b.png")], IMAGE)
    plan = plan_of(im.augment_images(images, 3))
    assert "MapInPandas" in plan and "Generate" not in plan
    rows = im.augment_images(images, 3).collect()
    assert len(rows) == 12
    drawn = {(r["origin"], r["aug"]): r for r in im.augment_params(images, 3).collect()}
    for r in rows:
        if r["aug"] != "original":
            want = drawn[r["origin"], r["aug"]]
            assert [r[c] for c in ("factor", "angle", "size", "left", "top")] == [want[c] for c in ("factor", "angle", "size", "left", "top")]


def test_equal_names_are_refused(spark, tmp_path):
    images = spark.createDataFrame([one_image("x/a.png"), one_image("y/a.png")], IMAGE).withColumn("out_name", F.lit("a.png"))
    with pytest.raises(ValueError, match="2 images have the file name a.png"):
        image_io.export_png(images, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists() or not list((tmp_path / "out").iterdir())
