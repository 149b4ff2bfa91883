"""Images, documents, chunking and streaming."""

import struct
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.operators import chunking, images as im, links
from threadloom.operators.history import history_window
from threadloom.operators.pairs import pair_replies
from threadloom.sources import documents, images as image_io, kb as kb_io, tweets
from threadloom.streaming.chat import stream_chat_turns
from threadloom.streaming.pairing import stream_pair_replies
from threadloom.streaming.runs import run_available


def png(pixels: np.ndarray) -> bytes:
    """A minimal RGB PNG file."""

    def part(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    h, w, _ = pixels.shape
    raw = b"".join(b"\0" + row.tobytes() for row in pixels)
    head = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


def test_scan_augment_and_sink_images(spark, tmp_path):
    rgb = np.arange(10 * 6 * 3, dtype=np.uint8).reshape(6, 10, 3)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.b.PNG").write_bytes(png(rgb))
    (folder / "broken.png").write_bytes(b"no image")
    (folder / "other.gif").write_bytes(png(rgb))
    found = image_io.scan_images(spark, str(folder))
    assert [Path(r["origin"]).name for r in found.collect()] == ["a.b.PNG"]
    out = {r["aug"]: r for r in im.augment_images(found, 7).collect()}
    assert set(out) == {*im.VARIANTS, "original"}
    bgr = rgb[..., ::-1]
    pixels = {k: np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], 3) for k, r in out.items()}
    assert (pixels["original"] == bgr).all() and (pixels["flipped"] == bgr[:, ::-1]).all()
    f = out["bright"]["factor"]
    assert 0.5 <= f <= 1.4
    assert (pixels["bright"] == np.clip(np.floor(bgr * f + 0.5), 0, 255)).all()
    assert out["cropped"]["size"] == 4 and pixels["cropped"].shape == bgr.shape
    assert -45 <= out["rotated"]["angle"] <= 45 and pixels["rotated"].shape[0] >= 6
    path = str(tmp_path / "out")
    image_io.sink_images(im.augment_images(found, 7), path)
    names = {r["out_name"] for r in spark.read.parquet(path).collect()}
    assert names == {"a.b.PNG", *(f"a.b_{v}.PNG" for v in im.VARIANTS)}


def test_exported_png_reads_back(spark, tmp_path):
    rgb = np.arange(5 * 7 * 3, dtype=np.uint8).reshape(5, 7, 3)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.png").write_bytes(png(rgb))
    images = image_io.scan_images(spark, str(tmp_path / "in"))
    image_io.export_png(images.withColumn("out_name", F.lit("b.png")), str(tmp_path / "out"))
    again = image_io.scan_images(spark, str(tmp_path / "out")).first()
    assert again["data"] == images.first()["data"] and again["origin"].endswith("out/b.png")


def test_rotation_keeps_or_turns_pixels():
    pixels = np.arange(12, dtype=np.uint8).reshape(3, 4, 1)
    assert (im._rotate(pixels, 0.0) == pixels).all()
    assert (im._rotate(pixels, 90.0) == np.rot90(pixels)).all()
    assert (im._rotate(pixels, -90.0) == np.rot90(pixels, -1)).all()


@pytest.mark.parametrize("size, overlap", [(30, 10), (50, 0), (17, 16)])
def test_chunk_properties(size, overlap):
    # Every piece of this text is unique, so a chunk has one place in it.
    words = " ".join(f"w{i}" + (". " if i % 5 == 0 else "") for i in range(60))
    text = words + "\n\nSix seven\nlong" + "".join(map(chr, range(0x4E00, 0x4E50))) + " end."
    chunks = chunking.split_text(text, size, overlap)
    assert chunks == chunking.split_text(text, size, overlap)
    assert all(0 < len(c) <= size for c in chunks)
    at = 0
    covered = set()
    for c in chunks:
        start = text.find(c, max(0, at - overlap))
        assert start >= 0
        covered |= set(range(start, start + len(c)))
        at = start + len(c)
    assert all(i in covered or ch.isspace() for i, ch in enumerate(text))


def test_chunk_golden():
    assert chunking.split_text("aaa bbb ccc", 8, 4) == ["aaa bbb", "bbb ccc"]
    assert chunking.split_text("abcdefgh", 3, 1) == ["abc", "cde", "efg", "gh"]
    assert chunking.split_text("", 10, 2) == [] and chunking.split_text(" \n ", 10, 2) == []
    assert chunking.split_text("a\n\nb", 100, 10) == ["a\n\nb"]


def test_chunk_rows(spark):
    docs = spark.createDataFrame([("s", "a b " * 400), ("t", None), ("u", "")], "source string, text string")
    rows = chunking.chunk_recursive(docs, ["source"]).orderBy("chunk_idx").collect()
    assert [r["chunk_idx"] for r in rows] == list(range(len(rows))) and {r["source"] for r in rows} == {"s"}
    paragraphs = spark.createDataFrame([("x" * 41 + "\n\nshort\n\n " + "y" * 41 + " ",)], "text string")
    got = chunking.chunk_paragraphs(paragraphs, []).collect()
    assert [(r["chunk_idx"], r["text"][0], len(r["text"])) for r in got] == [(0, "x", 41), (1, "y", 41)]


def test_tweets_csv_round_trip(spark, tmp_path):
    rows = [(1, "a", True, 'he said "hi",\nthen\\ left', None), (2, "b", False, "", 1), (3, "c", None, None, 2), (4, "d", True, " pad ", 3)]
    df = spark.createDataFrame(rows, tweets.TWEETS)
    tweets.write_tweets_csv(df, str(tmp_path / "csv"))
    got = tweets.scan_tweets(spark, str(tmp_path / "csv")).orderBy("tweet_id").collect()
    # CSV has one way to say "nothing": the empty text comes back as NULL.
    rows[1] = (2, "b", False, None, 1)
    assert [tuple(r) for r in got] == rows


def test_documents_urls_and_dump(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "m.txt").write_text("p1\n\np2 é\n", encoding="utf-8")
    doc = documents.scan_text_docs(spark, str(tmp_path / "docs")).first()
    assert doc["text"] == "p1\n\np2 é\n" and doc["source"].endswith("m.txt")
    urls = spark.createDataFrame([("http://a ",), ("http://a",), ("http://b",)], "url string")
    documents.save_urls(urls, str(tmp_path / "urls"))
    assert {r["url"] for r in documents.load_urls(spark, str(tmp_path / "urls")).collect()} == {"http://a", "http://b"}
    kb = spark.createDataFrame(
        [("s", 0, "far", [0.0, 1.0]), (None, 1, "near", [1.0, 0.0])],
        "source string, chunk_idx int, text string, embedding array<float>",
    )
    blocks = kb_io.kb_dump(kb, [1.0, 0.1], 10000)
    kb_io.save_dump(blocks, str(tmp_path / "dump"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "dump").glob("part-*")))
    assert text == "[1] Source: unknown\nnear\n\n[2] Source: s\nfar\n\n"
    assert kb_io.kb_dump(kb, [1.0, 0.1], None).orderBy("rank").collect() == blocks.orderBy("rank").collect()


CONVERSATIONS = "/root/testdata/sf0.001/conversations.parquet"


@pytest.fixture
def turn_files(spark, tmp_path):
    """Turns in three files that arrive one after the other, later turns first inside a file."""
    import os

    rows = spark.read.parquet(CONVERSATIONS).toPandas()
    folder = tmp_path / "turns"
    folder.mkdir()
    for i, (lo, hi) in enumerate([(0, 2), (3, 5), (6, 99)]):
        part = rows[rows["turn"].between(lo, hi)].sort_values("turn", ascending=False)
        part.to_parquet(folder / f"{i}.parquet", index=False)
        os.utime(folder / f"{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    return str(folder)


def open_stream(spark, folder):
    schema = spark.read.parquet(CONVERSATIONS).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_chat_stream_equals_batch(spark, turn_files):
    chat = run_available(stream_chat_turns(open_stream(spark, turn_files)), "chat")
    batch = history_window(spark.read.parquet(CONVERSATIONS))
    got = {(r["conv_id"], r["turn"], r["history"]) for r in chat.collect()}
    assert got == {(r["conv_id"], r["turn"], r["history"]) for r in batch.collect()}


def test_chat_stream_closing_and_retrieval(spark, tmp_path):
    rows = [(1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (1, 2, "user", " Quit "), (1, 3, "user", "again")]
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    facts = spark.createDataFrame([(1, ["f" * 60])], "conv_id long, contexts array<string>")
    chat = stream_chat_turns(source, lambda m: m.join(F.broadcast(facts), "conv_id", "left"))
    got = {r["turn"]: r for r in run_available(chat, "chat").collect()}
    assert got[0]["history"] == "Customer: hello" and "[1] fff" in got[0]["prompt"]
    assert got[2]["closed"] and got[2]["prompt"] is None
    assert got[3]["history"] == "Customer: again"


def test_idle_sessions_leave_the_state(spark, tmp_path):
    """A session that the watermark has passed is forgotten; a later turn of its key starts anew."""
    import os

    day = 86_400
    schema = "conv_id long, turn long, role string, text string, ts timestamp"
    folder = tmp_path / "in"
    folder.mkdir()
    steps = [[(c, 0, "user", f"hello {c}", 10 * day) for c in range(20)], [(50, 0, "user", "later", 14 * day)], [(51, 0, "user", "last", 18 * day)], [(3, 9, "user", "again", 18 * day)]]
    for i, rows in enumerate(steps):
        frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, s long")
        frame.selectExpr("conv_id", "turn", "role", "text", "timestamp_seconds(s) AS ts").toPandas().to_parquet(folder / f"{i}.parquet", index=False, coerce_timestamps="us")
        os.utime(folder / f"{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    query = (
        stream_chat_turns(source, event_time="ts", idle="1 day").writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True).start()
    )
    assert query.awaitTermination(300)
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(kept) >= 20 and kept[-1] <= 3
    got = {(r["conv_id"], r["turn"]): r["history"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(got) == 23 and got[3, 9] == "Customer: again"


def test_pair_stream_equals_batch(spark, turn_files):
    def view(df):
        conv, turn = F.col("conv_id"), F.col("turn")
        return df.where("role <> 'system'").select(
            (conv * 100 + turn).alias("tweet_id"),
            F.lit("c").alias("author_id"),
            (F.col("role") == "user").alias("inbound"),
            F.col("text").alias("cleaned_text"),
            F.when(turn > 0, conv * 100 + turn - 1).alias("in_response_to_tweet_id"),
            F.timestamp_seconds(turn * 60 + 1_577_836_800).alias("ts"),
        )

    live = view(open_stream(spark, turn_files))
    got = run_available(stream_pair_replies(live, view(open_stream(spark, turn_files))), "pairs")
    batch = pair_replies(view(spark.read.parquet(CONVERSATIONS)), keep_ids=True)
    key = lambda df: sorted((r["tweet_id"], r["reply_id"], r["input"], r["response"]) for r in df.collect())
    assert key(got) == key(batch) and got.count() > 0
