"""Maximal repetitions of words by string synchronising sets.

A run is a maximal stretch of words with a smallest period q that it holds at least twice. Texts of a
slice are numbered word by word into one array, with a number of its own between two texts, so
numpy searches all of them at once:

* Periods below ``DIRECT`` are the highly periodic regions; words are compared with those q places on.
* At scale t, for periods of 4t to 8t, a synchronising set holds the places whose window of t words,
  or the one t places on, has the least hash of the t + 1 windows from there, windows of a period of at most t/3 left
  out. Membership depends on the next 2t words only, and t neighbouring places of which
  none is in the set begin a highly periodic stretch of 3t - 1 words.
* In a run of period q the places of its first period repeat q words on with equal contexts, so two set
  members with equal contexts propose their distance as a period.
* A run without such a pair has a first period that is highly periodic but for its last word. Then it spans two
  neighbouring runs of one small period, which propose every distance that brings their phases together.

Every proposal is extended by hashes of 1, 2, 4 .. words to its full length and compared word by word. Of
one stretch the smallest period counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.common import BLANKS, small_slices, text_bytes

MIN_LENGTH = 12
DIRECT = 16  # smaller periods are found without sets
_FIRST_SCALE = DIRECT // 4
_NONE = np.uint64(2**64 - 1)
_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _Words:
    """The words of one or more texts as numbers, with hashes of 1, 2, 4 .. consecutive ones."""

    def __init__(self, words: np.ndarray, longest: int, seed: int):
        self.words = words
        self.levels = [_mixed(words.astype(np.uint64) + np.uint64(seed))]
        # Without them every level would hash words to the same numbers.
        salts = np.random.default_rng(seed).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        while 2 << (len(self.levels) - 1) <= longest:
            last, k = self.levels[-1], len(self.levels)
            step = 1 << (k - 1)
            self.levels.append(_mixed(last[:-step] * salts[k] + last[step:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and from ``b`` on are equal; ``a < b`` each."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            x, y = a + length, b + length
            inside = np.flatnonzero(y < len(level))
            length[inside[level[x[inside]] == level[y[inside]]]] += 1 << k
        return length

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words just before ``a`` and ``b`` are equal; ``a < b`` each."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            x, y = a - length - (1 << k), b - length - (1 << k)
            inside = np.flatnonzero(x >= 0)
            length[inside[level[x[inside]] == level[y[inside]]]] += 1 << k
        return length

    def extended(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """``start, end, period`` of the stretches through ``at`` and ``at + period`` that hold their period twice."""
        start = at - self.common_before(at, at + period)
        end = at + period + self.common(at, at + period)
        twice = end - start >= 2 * period
        return np.stack((start, end, period), axis=1)[twice]


def _direct_runs(words: np.ndarray) -> np.ndarray:
    """``start, end, period`` of all stretches that hold a period below ``DIRECT`` at least twice."""
    found = [np.zeros((0, 3), np.int64)]
    for q in range(1, min(DIRECT, len(words) // 2 + 1)):
        equal = np.zeros(len(words) - q + 2, np.int8)
        equal[1:-1] = words[:-q] == words[q:]
        edges = np.flatnonzero(np.diff(equal))
        start, end = edges[::2], edges[1::2] + q
        long = end - start >= 2 * q
        found.append(np.stack((start[long], end[long], np.full(long.sum(), q)), axis=1))
    return np.concatenate(found)


def _smallest_periods(runs: np.ndarray) -> np.ndarray:
    """One row per stretch, with its smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if not len(runs):
        return runs
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def synchronising_set(hashes: np.ndarray, scale: int, periodic: np.ndarray) -> np.ndarray:
    """The members, ascending: places whose window, or the one ``scale`` on, has the least hash of those between.

    ``hashes`` are those of all windows of ``scale`` words, ``periodic`` marks the windows left out.
    """
    x = np.where(periodic, _NONE, hashes)
    n = len(x) - scale
    if n <= 0:
        return np.zeros(0, np.int64)
    least, width = x, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], x[scale:])
    return np.flatnonzero((least != _NONE) & ((least == x[:n]) | (least == x[scale:])))


def _periodic_windows(runs: np.ndarray, scale: int, n: int) -> np.ndarray:
    """Marks the windows of ``scale`` words, ``n`` of them, that have a period of at most a third of it."""
    own = runs[(3 * runs[:, 2] <= scale) & (runs[:, 1] - runs[:, 0] >= scale)]
    edges = np.bincount(own[:, 0], minlength=n + 1) - np.bincount(own[:, 1] - scale + 1, minlength=n + 1)
    return np.cumsum(edges)[:n] > 0


def _equal_context_pairs(members: np.ndarray, contexts: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """``place, distance`` of members with equal contexts that are 4 to 8 scales apart.

    A context is not highly periodic, so it recurs at most every third of a scale: few partners each.
    """
    order = np.argsort(contexts, kind="stable")
    at, context = members[order], contexts[order]
    places, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for ahead in range(1, len(at)):
        same = context[ahead:] == context[:-ahead]
        apart = at[ahead:] - at[:-ahead]
        if not (same & (apart < 8 * scale)).any():
            break
        hit = same & (apart >= 4 * scale) & (apart < 8 * scale)
        places.append(at[:-ahead][hit])
        distances.append(apart[hit])
    return np.concatenate(places), np.concatenate(distances)


def _phase(words: np.ndarray, left: int, right: int, period: int) -> int | None:
    """How far after ``right`` the ``period`` words from ``left`` on stand first."""
    root, there = words[left : left + period].tobytes(), words[right : right + 2 * period - 1].tobytes()
    at = there.find(root)
    while at > 0 and at % words.itemsize:
        at = there.find(root, at + 1)
    return None if at < 0 else at // words.itemsize


def _phase_proposals(runs: np.ndarray, words: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """``place, distance`` from neighbouring runs of one small period, brought to one phase, 4 to 8 scales apart."""
    runs = runs[(3 * runs[:, 2] <= scale) & (runs[:, 1] - runs[:, 0] >= 4 * scale - 1)]
    runs = runs[np.lexsort((runs[:, 0], runs[:, 2]))]
    left, right = runs[:-1], runs[1:]
    gap = right[:, 0] - left[:, 1]
    near = (left[:, 2] == right[:, 2]) & (gap > -left[:, 2]) & (gap <= 1)
    places, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for (b1, e1, p), (b2, e2, _) in zip(left[near].tolist(), right[near].tolist(), strict=True):
        phase = _phase(words, b1, b2, p)
        if phase is None:  # other words than the left run's
            continue
        least, most = 4 * scale, min(e1 - b1 + 1, e2 - b2 + 1, 8 * scale - 1)
        distance = np.arange(least + (b2 + phase - b1 - least) % p, most + 1, p)
        places.append(np.maximum(b1, b2 - distance))
        distances.append(distance)
    return np.concatenate(places), np.concatenate(distances)


def word_runs(words: np.ndarray, lengths: np.ndarray, min_length: int = MIN_LENGTH, seed: int = 12) -> np.ndarray:
    """All runs of texts as rows ``text, start, length, period``, by text, start, period.

    ``words`` numbers the words of all texts, one after the other; ``lengths`` are those of the texts.
    """
    words = np.asarray(words, np.int64)
    first = np.cumsum(lengths) - lengths
    found: list[np.ndarray] = []
    # Scale by scale over the texts that are long enough for its periods, each ended by a number of its own.
    kept = np.arange(len(lengths))
    base = np.zeros(len(lengths), np.int64)
    known = np.zeros((0, 3), np.int64)  # runs so far, in the places of the texts kept
    hashed, scale = None, 0
    while (still := lengths[kept] >= max(2, 8 * scale)).any():
        if not scale or not still.all():
            before, kept = base, kept[still]
            size = lengths[kept] + 1
            base = np.cumsum(size) - size
            which = np.repeat(np.arange(len(kept)), size)
            inner = np.arange(len(which)) - base[which]
            ends = inner == size[which] - 1
            joined = np.empty(len(which), np.int64)
            joined[~ends] = words[(first[kept][which] + inner)[~ends]]
            joined[ends] = -1 - np.arange(len(kept))
            own = np.searchsorted(before, known[:, 0], side="right") - 1
            known, own = known[still[own]], own[still[own]]
            known[:, :2] += (base[np.cumsum(still)[own] - 1] - before[own])[:, None]
            hashed = None
        if scale:
            hashed = hashed or _Words(joined, int(lengths[kept].max()), seed)
            level = scale.bit_length() - 1
            window, context = hashed.levels[level], hashed.levels[level + 1]
            members = synchronising_set(window, scale, _periodic_windows(known, scale, len(window)))
            pairs = _equal_context_pairs(members, context[members], scale)
            phases = _phase_proposals(known, joined, scale)
            fresh = np.concatenate((hashed.extended(*pairs), hashed.extended(*phases)))
        else:
            fresh = _direct_runs(joined)
        fresh = _smallest_periods(fresh)
        known = _smallest_periods(np.concatenate((known, fresh)))
        owner = np.searchsorted(base, fresh[:, 0], side="right") - 1
        found.append(np.stack((kept[owner], fresh[:, 0] - base[owner], fresh[:, 1] - fresh[:, 0], fresh[:, 2]), axis=1))
        scale = 2 * scale or _FIRST_SCALE
    if not found:
        return np.zeros((0, 4), np.int64)
    runs = np.concatenate(found)
    runs = runs[runs[:, 2] >= np.maximum(min_length, 2 * runs[:, 3])]
    # Of one stretch the smallest period.
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    once = np.ones(len(runs), bool)
    once[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)
    runs = runs[once]
    runs = runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]
    starts = first[runs[:, 0]] + runs[:, 1]
    for start, length, period in zip(starts.tolist(), runs[:, 2].tolist(), runs[:, 3].tolist(), strict=True):
        if not np.array_equal(words[start : start + length - period], words[start + period : start + length]):
            return word_runs(words, lengths, min_length, seed + 1)  # two hashes met: take others
    return runs


def numbered_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, equal for equal words, and how many each text has."""
    raw, starts = text_bytes(texts)
    white = _WHITE[raw]
    begins = np.zeros(len(raw) + 1, bool)
    begins[1 : len(raw)] = white[:-1] & ~white[1:]
    begins[starts[:-1]] = True
    begins[:-1] &= ~white
    begins = np.flatnonzero(begins[:-1])
    lengths = np.diff(np.searchsorted(begins, starts))
    if not len(begins):
        return np.zeros(0, np.int64), lengths
    # Without white space the words lie one after the other.
    solid = raw[~white]
    offsets = begins - np.cumsum(white)[begins]
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(np.append(offsets, len(solid))), pa.py_buffer(solid)]
    )
    return words.dictionary_encode().indices.to_numpy().astype(np.int64), lengths


RUNS = "array<struct<start: long, length: long, period: long>>"
SCHEMA = f"doc_id long, runs {RUNS}, collapsed string"
_RUN_FIELDS = ["start", "length", "period"]


def collapsed_words(words: list[bytes], runs: list[list[int]]) -> list[bytes]:
    """``words`` without those that some run contains after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``doc_id, runs, collapsed`` for every row of ``docs``.

    ``runs`` lists ``start, length, period`` (in words, from 0) of every run of at least ``min_length`` words,
    by start and period; ``collapsed`` holds the words that no run repeats, joined by a blank. Null and empty texts
    have no words; null ids and repeated rows are searched like any other; an empty table
    gives no rows; columns other than ``doc_id`` and ``text`` are not read. Texts are searched
    whole, some 4 MB of them or one longer text at a time; memory grows with the longest text's words times
    the logarithm of their number.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in small_slices(batch.column(1)):
                words, lengths = numbered_words(texts)
                rows = word_runs(words, lengths, min_length)
                bounds = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
                spans = rows[:, 1:].tolist()
                raw, starts = text_bytes(texts)
                data, at, cuts = raw.tobytes(), starts.tolist(), bounds.tolist()
                collapsed = [
                    b" ".join(collapsed_words(data[at[i] : at[i + 1]].split(), spans[cuts[i] : cuts[i + 1]])).decode()
                    for i in range(len(texts))
                ]
                listed = pa.StructArray.from_arrays([pa.array(c) for c in rows[:, 1:].T], _RUN_FIELDS)
                columns = [
                    batch.column(0).slice(done, len(texts)),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), listed),
                    pa.array(collapsed, pa.string()),
                ]
                done += len(texts)
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(search, SCHEMA)


# --- the registered query -----------------------------------------------------
def plant_repetitions(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the repetitions that the registered query's contract plants.

    With h the crc32 of the id's text and g a tenth of it: of every tenth id, words from a = g % n on become the words
    from a to a + p over and over, p = 1 + (n - a) / (3 + g % 8). Null ids and texts stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", BLANKS), lambda w: w != "")
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("_g"), F.when(h % 10 == 0, words).alias("_words"))
    n = F.size("_words").cast("long")
    placed = chosen.select("doc_id", "text", "_words", n.alias("_n"), "_g", F.when(n > 0, F.col("_g") % n).alias("_a"))
    period = 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))
    placed = placed.withColumn("_p", period)
    source = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p")))
    moved = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1), lambda i: F.get("_words", source(i).cast("int")))
    return placed.select("doc_id", F.when(F.col("_n") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """The longest run of each row, digests of all runs and of the collapsed text."""
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("_longest"), listed.alias("_lines"), "collapsed"
    ).select(
        "doc_id",
        "n_runs",
        (-F.col("_longest.start")).alias("start"),
        F.col("_longest.length").alias("length"),
        (-F.col("_longest.period")).alias("period"),
        F.expr("(1000 * _longest.length) div (-_longest.period)").alias("exponent_milli"),
        F.sha2(F.col("_lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
