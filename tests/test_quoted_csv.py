"""The splitting CSV reader against Spark's reader of one task per file."""

import random

import pytest
from pyspark.sql import types as T

from threadloom.schemas import TWEETS
from threadloom.sources.quoted_csv import ends_inside, read_quoted_csv
from threadloom.sources.tweets import scan_tweets

HEADER = ",".join(TWEETS.fieldNames())
TEXTS = ["plain", '"a, ""quoted"" one"', '"two\nlines"', '"\n\n, ""x"",\n"', '"carriage\r\nreturn"', "", 'stray " quote', '"ünï ""\n"" çode"', '""', '"' + "long, \n" * 40 + '"']


def one_task(spark, path, bad=None):
    schema = TWEETS if bad is None else T.StructType([*TWEETS.fields, T.StructField(bad, T.StringType())])
    return spark.read.schema(schema).options(header=True, multiLine=True, escape='"', columnNameOfCorruptRecord=bad or "_x").csv(path)


def rows_of(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


@pytest.fixture()
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "150")
    spark.conf.set(names[1], "1")
    yield
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def line(i, text):
    return f"{i},author{i % 3},{'True' if i % 2 else 'False'},{text},{i - 1 if i % 4 else ''}"


def save(folder, *files):
    folder.mkdir()
    for n, text in enumerate(files):
        (folder / f"part-{n}.csv").write_bytes(text.encode())
    return str(folder)


def test_equals_the_one_task_reader(spark, small_splits, tmp_path):
    rng = random.Random(4)
    files = [
        "\n".join([HEADER, *(line(1000 * f + i, rng.choice(TEXTS)) for i in range(120))]) + "\n" * f
        for f in range(3)
    ]
    path = save(tmp_path / "csv", *files)
    got = scan_tweets(spark, path)
    assert rows_of(got) == rows_of(one_task(spark, path))
    assert got.count() == 360
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 20


def test_broken_rows_are_kept(spark, small_splits, tmp_path):
    body = [line(1, "ok"), "2,too few", line(3, "x") + ",too,many", "seven" + line(4, '"not\na number"'), "", line(5, '"fine\n"')]
    path = save(tmp_path / "csv", "\n".join([HEADER, *body]) + "\n", HEADER + "\n", "")
    got = scan_tweets(spark, path, "bad")
    assert rows_of(got) == rows_of(one_task(spark, path, "bad"))
    assert [r["bad"] for r in got.where("bad IS NOT NULL").collect()].count("2,too few") == 1
    assert got.count() == 5


def test_unclosed_value(spark, small_splits, tmp_path):
    rest = [line(i, "x") for i in range(2, 40)]
    path = save(tmp_path / "csv", "\n".join([HEADER, line(1, "ok"), line(99, '"never closed'), *rest]) + "\n")
    got = read_quoted_csv(spark, path, TWEETS, "bad", max_record_chars=100)
    assert got.where("bad IS NULL").count() == 1
    pieces = [r["bad"] for r in got.where("bad IS NOT NULL").collect()]
    assert sum(p.count("\n") + 1 for p in pieces) == 39 and len(pieces) > 5
    assert read_quoted_csv(spark, path, TWEETS).count() == 2


@pytest.mark.parametrize(
    "text, from_outside, from_inside",
    [("a,b", False, True), ('a,"b', True, False), ('a,"b"', False, False), ('say "x', False, False), ('""', False, True), ('"a""', True, False), ('a""b', False, True), ('x","y', True, True), ('x"y,"z', True, True), ('x",y', False, False)],
)
def test_state_after_a_line(text, from_outside, from_inside):
    assert ends_inside(text, False) is from_outside
    assert ends_inside(text, True) is from_inside
