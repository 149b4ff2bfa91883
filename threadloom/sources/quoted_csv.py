"""Quoted CSV with line breaks inside values, read by many tasks per file.

Spark splits the file at line ends, but a line end inside quotes ends no record. Whether a
byte range starts inside quotes depends on everything before it. A first pass tells for each
range in which state it ends for either state at its start; these are chained per file, and a
second pass, which knows its start, puts the lines of each record together. Only the pieces
of records that cross ranges are shuffled.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

# A value that is never closed swallows the rest of its file. Pieces of a record that crosses
# ranges and is longer than this stay apart, each as a broken row.
MAX_RECORD_CHARS = 64 << 20


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a value in quotes is open after ``line``; it opens only where a value starts."""
    at = 0
    while True:
        if inside:
            close = line.find('"', at)
            while close >= 0 and line.startswith('""', close):
                close = line.find('"', close + 2)
            if close < 0:
                return True
            comma = line.find(",", close + 1)
            if comma < 0:
                return False
            at, inside = comma + 1, False
        elif line.startswith('"', at):
            at, inside = at + 1, True
        else:
            following = line.find(',"', at)
            if following < 0:
                return False
            at, inside = following + 2, True


def _ranges(batch: pd.DataFrame) -> Iterator[tuple[tuple[str, int], np.ndarray]]:
    """The lines of each byte range in the batch, in file order."""
    key = batch["file"].ne(batch["file"].shift()) | batch["block"].ne(batch["block"].shift())
    for _, part in batch.groupby(key.cumsum(), sort=False):
        yield (part["file"].iat[0], int(part["block"].iat[0])), part["value"].to_numpy()


def _chained(lines: np.ndarray, inside: bool) -> bool:
    for line in lines:
        if '"' in line:
            inside = ends_inside(line, inside)
    return inside


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        )
    )


def _open_ranges(lines: DataFrame) -> dict[str, np.ndarray]:
    """Per file the ranges that start inside quotes: eight bytes for each range of a long file."""

    def run(batches):
        now, ends = None, (False, True)
        for batch in batches:
            for key, values in _ranges(batch):
                if key != now:
                    if now is not None:
                        yield pd.DataFrame([(*now, *ends)], columns=["file", "block", "outside", "inside"])
                    now, ends = key, (False, True)
                ends = tuple(_chained(values, e) for e in ends) if ends[0] != ends[1] else (_chained(values, ends[0]),) * 2
        if now is not None:
            yield pd.DataFrame([(*now, *ends)], columns=["file", "block", "outside", "inside"])

    ends = lines.mapInPandas(run, "file string, block long, outside boolean, inside boolean")
    # A range either sets the state (both ends equal) or keeps or flips it. The state is the
    # last one that was set, flipped as often as ranges have done so since.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    flip = F.when((F.col("outside") != F.col("inside")) & F.col("outside"), 1).otherwise(0)
    flips = F.coalesce(F.sum("flip").over(before), F.lit(0))
    chained = (
        ends.withColumn("flip", flip)
        .withColumn("flips", flips)
        .withColumn("set", F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").cast("int").alias("to"), "flips")))
        .withColumn("last", F.last("set", ignorenulls=True).over(before))
        .withColumn("state", (F.coalesce("last.to", F.lit(0)) + F.col("flips") - F.coalesce("last.flips", F.lit(0))) % 2)
        .where("state = 1")
    )
    found = chained.groupBy("file").agg(F.sort_array(F.collect_list("block")).alias("blocks")).toPandas()
    return {file: np.array(blocks) for file, blocks in zip(found["file"], found["blocks"])}


class _Range:
    """Puts the lines of one byte range together."""

    def __init__(self, key: tuple[str, int], inside: bool):
        self.key, self.inside, self.open = key, inside, []
        self.kind = "head" if inside else "whole"
        self.header = key[1] == 0

    def row(self, kind: str):
        text = "\n".join(self.open)
        first, self.header = self.header and bool(text.rstrip("\r")), self.header and not text.rstrip("\r")
        self.open = []
        return (*self.key, kind, first, text)

    def add(self, lines: np.ndarray):
        for line in lines:
            self.open.append(line)
            if '"' in line:
                self.inside = ends_inside(line, self.inside)
            if not self.inside:
                yield self.row(self.kind)
                self.kind = "whole"

    def end(self):
        """What is still open goes on in the next range."""
        if self.open:
            yield self.row("middle" if self.kind == "head" else "tail")


def _pieces(lines: DataFrame, open_ranges: dict[str, np.ndarray]) -> DataFrame:
    """Records (``whole``) and pieces of records that cross ranges (``tail, middle, head``)."""
    shared = lines.sparkSession.sparkContext.broadcast(open_ranges)
    columns = ["file", "block", "kind", "first", "record"]

    def run(batches):
        current, known = None, shared.value
        for batch in batches:
            out = []
            for key, values in _ranges(batch):
                if current is None or current.key != key:
                    if current is not None:
                        out += current.end()
                    current = _Range(key, key[1] in known.get(key[0], ()))
                out += current.add(values)
            if out:
                yield pd.DataFrame(out, columns=columns)
        last = list(current.end()) if current is not None else []
        if last:
            yield pd.DataFrame(last, columns=columns)

    return lines.mapInPandas(run, "file string, block long, kind string, first boolean, record string")


def _joined(pieces: DataFrame, max_chars: int) -> DataFrame:
    """Records that cross ranges; pieces of one beyond the bound stay apart and are broken."""
    order = Window.partitionBy("file").orderBy("block", F.when(F.col("kind") == "tail", 1).otherwise(0))
    number = F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(order)
    numbered = pieces.where("kind <> 'whole'").withColumn("number", number)
    sized = numbered.withColumn("chars", F.sum(F.length("record")).over(Window.partitionBy("file", "number")))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("block", "record"))), lambda p: p["record"])
    short = (
        sized.where(F.col("chars") <= max_chars)
        .groupBy("file", "number")
        .agg(F.bool_or("first").alias("first"), F.array_join(parts, "\n").alias("record"))
    )
    long = sized.where(F.col("chars") > max_chars)
    return short.select("first", "record", F.lit(False).alias("broken")).unionByName(
        long.select("first", "record", F.lit(True).alias("broken"))
    )


def read_quoted_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    bad_col: str | None = None,
    max_record_chars: int = MAX_RECORD_CHARS,
) -> DataFrame:
    """Rows of CSV files with a header line each; quotes inside values are doubled.

    The result is that of Spark's own multi-line reader, which reads a file in one task.
    ``bad_col`` adds a column that holds the text of a record that does not fit the schema and
    is NULL for all others; the values that could be read stay. Blank lines are no records.
    """
    lines = _lines(spark, path)
    pieces = _pieces(lines, _open_ranges(lines))
    whole = pieces.where("kind = 'whole'").select("first", "record", F.lit(False).alias("broken"))
    records = (
        whole.unionByName(_joined(pieces, max_record_chars))
        .where(~F.col("first"))
        .select(F.regexp_replace("record", "\r$", "").alias("record"), "broken")
        .where("record <> ''")
    )
    bad = bad_col or "_bad_record"
    fields = [*schema.fields, T.StructField(bad, T.StringType())]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": bad}
    text = F.when(~F.col("broken"), F.col("record"))
    parsed = F.from_csv(text, ddl, options)
    rows = records.select(parsed.alias("row"), "record", "broken")
    kept = [F.col("row")[name].alias(name) for name in schema.fieldNames()]
    if bad_col:
        kept.append(F.when(F.col("broken"), F.col("record")).otherwise(F.col("row")[bad]).alias(bad_col))
    return rows.select(*kept)
