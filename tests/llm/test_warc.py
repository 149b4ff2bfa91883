import gzip
import hashlib
import io

import pytest

from threadloom.llm import warc

BIG = "<p>" + "ä" * 600 + "</p>"


@pytest.fixture
def pages(spark):
    rows = [
        (1, "http://a/1", BIG, "x"), (5, "http://a/5?q=ü b\r\nX: y", BIG, "x"), (3, None, BIG, "x"), (3, None, BIG, "x"), (None, "http://n", BIG, "x"),
        (7, "http://s", "short", "x"), (8, "http://s", "short", "x"), (9, "u", None, "x"), (10, "u", "", "x"), (11, "u", "z" * 300_000, "x"),
        (12, "u", "WARC/1.1\r\n\r\n" * 200, "x"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def expected(rows):
    out = []
    for r in rows:
        data = (r.html or "").encode()
        same = [x.page_id for x in rows if x.html == r.html and x.page_id is not None]
        own = max(same) if len(data) >= 1000 and same else r.page_id
        out.append((r.page_id, len(data), hashlib.sha1(data).hexdigest(), "response" if own == r.page_id else "revisit", None if own == r.page_id else own))
    return sorted(out, key=str)


def test_round_trip_of_odd_pages(pages):
    got = [tuple(r) for r in warc.archive_round_trip(pages).collect()]
    assert sorted(got, key=str) == expected(pages.collect())
    assert warc.archive_round_trip(pages.where("false")).count() == 0


def test_only_null_ids_are_all_responses(spark):
    pages = spark.createDataFrame([(None, "u", BIG), (None, "v", BIG)], "page_id long, url string, html string")
    assert [r.record_type for r in warc.archive_round_trip(pages).collect()] == ["response"] * 2


def record(html="hello", **changes):
    digest = hashlib.sha1(html.encode()).hexdigest()
    row = {"page_id": 4, "url": "http://x", "html": html, "digest": digest, "bytes": len(html.encode()), "refers_to": None, "refers_url": None}
    return warc.page_record(row | changes)


def test_members_stand_alone_and_payloads_come_back():
    html = "ü" * 200_000
    data = warc.info_record() + record(html) + record("") + record(refers_to=9, refers_url=None)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 4
    reader = warc.WarcReader(io.BytesIO(data), keep_payload=True)
    seen = [(r.headers["warc-type"], reader.payload.decode()) for r in reader]
    assert [t for t, _ in seen] == ["warcinfo", "response", "response", "revisit"]
    assert [p for _, p in seen[1:]] == [html, "", ""]


class Trickle(io.BytesIO):
    """Gives few bytes at a time, so that members end anywhere in a read."""

    def read(self, n=-1):
        return super().read(min(n, 7) if n > 0 else n)


def test_reads_may_end_anywhere():
    data = b"".join(record(f"text {i} " * i) for i in range(30))
    assert [r.payload_bytes for r in warc.WarcReader(Trickle(data))] == [len(f"text {i} " * i) for i in range(30)]


def repacked(change):
    plain = gzip.decompress(record("hello"))
    return gzip.compress(change(plain))


@pytest.mark.parametrize(
    "data",
    [
        record(digest=hashlib.sha1(b"other").hexdigest()),
        record(bytes=4),
        repacked(lambda p: p.replace(b"hello", b"hellO")),
        repacked(lambda p: p + b"more"),
        repacked(lambda p: p[:-8]),
        repacked(lambda p: p.replace(b"WARC/1.1", b"WORC/1.1")),
        record("hello" * 100)[:-30],
    ],
)
def test_damage_is_reported(data):
    with pytest.raises((ValueError, EOFError)):
        list(warc.WarcReader(io.BytesIO(data)))
