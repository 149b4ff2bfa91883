"""Toxicity by noisy-channel deobfuscation.

A disguised word is a lattice of readings: look-alike characters, masked letters,
stretched runs, separators between letters and letters set apart. A Viterbi search
under a four-character language model, counted over all documents, picks the likeliest
reading. The restored words of a text then go through a logistic model learnt from labels.

A word of plain letters has a one-path lattice, so it is its own reading and is not searched.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.common import held_out, plain_texts, text_bytes, training_sample

MAX_TRAIN = 10_000
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
VOCABULARY = 300
MIN_TOXIC_DOCS = 8
PREFIXES = (4, 5, 6, 7)  # a stem marks a word whatever its ending

# What a look-alike character may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¢": "c", "(": "c",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "т": "t", "м": "m", "к": "k", "н": "h", "в": "b",
}
VOWELS = "aeiou"
MASKS = "*#"
SEPARATORS = ".-_~·'’/"
INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])

# Costs in nats of the channel: how readily a writer disguises or keeps a character.
KEEP_SYMBOL = 8.0
READ_SYMBOL = 0.5
MASKED = 2.5
DROP_SEPARATOR = 1.0
KEEP_SEPARATOR = 1.0
DOUBLE_OF_RUN = 1.0

_EDGE = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~" + "«»„“”‘’…–—·¿¡§°€£¢"
_LEFT_READINGS = frozenset("@$!|€£¢")
_RIGHT_READINGS = frozenset("@$€£¢")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_RUNS = re.compile(r"(.)\1*", re.DOTALL)

LETTERS = 27  # a boundary and a to z
_GRAM = 4
_TABLE_SIZE = LETTERS**_GRAM
# Four or more single symbols set apart, the last one perhaps before punctuation.
_APART = re.compile(r"(?<!\S)[^\W_](?:[ \t]{1,3}(?:[^\W_]|[@$!|€£+])(?![^\s.,;:?!])){3,}")
_CACHE = 100_000


# --- language model ---------------------------------------------------------
def _letter_codes() -> np.ndarray:
    codes = np.zeros(256, np.int32)
    for i in range(26):
        codes[ord("a") + i] = codes[ord("A") + i] = i + 1
    return codes


def gram_counts(docs: DataFrame) -> DataFrame:
    """``code, n``: letter four-grams of all documents, counted per task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _letter_codes()
        total = np.zeros(_TABLE_SIZE, np.int64)
        for batch in batches:
            raw, _ = text_bytes(batch.column(0), tail="\n\n\n")
            for start in range(0, max(len(raw) - 3, 0), 1 << 22):
                c = table[raw[start : start + (1 << 22) + 3]]
                grams = ((c[:-3] * LETTERS + c[1:-2]) * LETTERS + c[2:-1]) * LETTERS + c[3:]
                total += np.bincount(grams, minlength=_TABLE_SIZE)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["code", "n"])

    counted = docs.select("text").mapInArrow(count, "code int, n long")
    return counted.groupBy("code").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class CharacterModel:
    """Log probability of a character after three others, flat over 27**4 entries."""

    log_probability: np.ndarray

    @staticmethod
    def fit(docs: DataFrame, back_off: float = 5.0) -> CharacterModel:
        """Interpolated four-gram model; at most 27**4 counts reach the driver, whatever the corpus."""
        counted = gram_counts(docs).toPandas()
        c4 = np.zeros(_TABLE_SIZE)
        c4[counted["code"].to_numpy(np.int64)] = counted["n"].to_numpy(float)
        c4 = c4.reshape((LETTERS,) * 4)
        p = (c4.sum((0, 1, 2)) + 1.0) / (c4.sum() + LETTERS)
        for axes in ((0, 1), (0,), ()):
            c = c4.sum(axes)
            p = (c + back_off * p) / (c.sum(-1, keepdims=True) + back_off)
        return CharacterModel(np.log(p).astype(np.float32).ravel())


# --- lattice ----------------------------------------------------------------
Reading = tuple[str, float]


def _readings(symbol: str, run: int, inner: bool) -> list[Reading] | None:
    """What ``run`` equal symbols may stand for, with channel costs."""
    if symbol.isalpha() and symbol not in LOOK_ALIKES:
        if run < 3:
            return [(symbol * run, 0.0)]
        return [(symbol, 0.0), (symbol * 2, DOUBLE_OF_RUN)]
    if symbol in LOOK_ALIKES:
        reads = [(x * min(run, 2), READ_SYMBOL) for x in LOOK_ALIKES[symbol]]
        if run > 1:
            reads += [(x, READ_SYMBOL + DOUBLE_OF_RUN) for x in LOOK_ALIKES[symbol]]
        return [*reads, (symbol * run, KEEP_SYMBOL)]
    if symbol in MASKS and inner:
        return [(v, MASKED) for v in VOWELS] + [("", DROP_SEPARATOR), (" ", KEEP_SEPARATOR * 2)]
    if inner:
        return [("", DROP_SEPARATOR), (" ", KEEP_SEPARATOR)]
    return [(" ", 0.0)]


def lattice(core: str) -> list[list[Reading]]:
    runs = [(m[1], len(m[0])) for m in _RUNS.finditer(core)]
    last = len(runs) - 1
    return [_readings(symbol, n, 0 < i < last) for i, (symbol, n) in enumerate(runs)]


class Decoder:
    """Viterbi search over lattices, with the state being the last three characters."""

    def __init__(self, model: CharacterModel):
        self.log_probability = array("f", model.log_probability.tobytes())
        self.cache: dict[str, tuple[str, ...]] = {}

    def best(self, nodes: list[list[Reading]]) -> str:
        """The likeliest reading; of equal ones, the one listed first."""
        lp = self.log_probability
        states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        size3 = LETTERS**3
        for readings in [*nodes, [(" ", 0.0)]]:
            reached: dict[int, tuple[float, tuple | None]] = {}
            for state, (score, path) in states.items():
                for reading, cost in readings:
                    total, at = score - cost, state
                    for ch in reading:
                        o = ord(ch) - 96
                        code = at * LETTERS + (o if 1 <= o <= 26 else 0)
                        total += lp[code]
                        at = code % size3
                    if at not in reached or total > reached[at][0]:
                        reached[at] = (total, (path, reading))
            states = reached
        _, path = max(states.values(), key=lambda x: x[0])
        parts = []
        while path is not None:
            path, reading = path
            parts.append(reading)
        return "".join(reversed(parts[1:]))  # without the closing border

    def token(self, token: str) -> tuple[str, ...]:
        """The words one lower-case token stands for; short tokens are remembered."""
        words = self.cache.get(token)
        if words is None:
            words = self._token(token)
            if len(token) <= 40:
                if len(self.cache) >= _CACHE:
                    self.cache.clear()
                self.cache[token] = words
        return words

    def _token(self, token: str) -> tuple[str, ...]:
        core = token.strip(_EDGE)
        if len(core) < len(token):
            core = _with_edges(token, core)
        if not core:
            return ()
        foreign = not core.isascii() and not LOOK_ALIKES.keys().isdisjoint(core)
        if (core.isalpha() and not foreign and not _TRIPLE.search(core)) or core.isdigit():
            return (core,)
        return tuple(self.best(lattice(core)).split())

    def _apart(self, found: re.Match) -> str:
        """Letters set apart, as one lattice in which every gap may be none or a word border."""
        nodes: list[list[Reading]] = []
        for symbol in found[0].split():
            if nodes:
                nodes.append([("", DROP_SEPARATOR), (" ", KEEP_SEPARATOR)])
            nodes.append(_readings(symbol, 1, False))
        return f" {self.best(nodes)} "

    def tokens(self, text: str) -> list[str]:
        """Lower-case tokens of a text, letters set apart already joined."""
        text = text.lower().translate(INVISIBLE) if not text.isascii() else text.lower()
        return _APART.sub(self._apart, text).split()

    def words(self, text: str) -> list[str]:
        """All words of a text in order, disguised ones restored."""
        return [w for token in self.tokens(text) for w in self.token(token)]

    def distinct_words(self, text: str) -> set[str]:
        """The set of ``words``, reading each different token once."""
        return set().union(*map(self.token, set(self.tokens(text))))


def text_features(words: set[str]) -> set[str]:
    """The words, their longer prefixes (starred), and prefixes that two or more of them share."""
    out = set(words)
    for n in PREFIXES:
        stems = [f"{w[:n]}*" for w in words if len(w) >= n]
        once = set(stems)
        if len(once) < len(stems):
            out.update(f"{stem}*" for stem, k in Counter(stems).items() if k > 1)
        out |= once
    return out


def _with_edges(token: str, core: str) -> str:
    """Give a stripped core back a single look-alike at its edges; longer runs are decoration."""
    if not core:
        return core
    start = token.index(core)
    end = start + len(core)
    if start and token[start - 1] in _LEFT_READINGS and (start == 1 or token[start - 2] not in _EDGE):
        core = token[start - 1] + core
    if end < len(token) and token[end] in _RIGHT_READINGS and token[end + 1 : end + 2] != token[end]:
        core += token[end]
    return core


# --- model on restored words ------------------------------------------------
@dataclass(frozen=True)
class ToxicityModel:
    characters: CharacterModel
    weights: dict[str, float]
    bias: float

    def score(self, words: set[str]) -> float:
        """Probability from the distinct words of a text."""
        hits = self.weights.keys() & text_features(words)
        raw = self.bias + sum(self.weights[f] for f in sorted(hits))
        return float(1.0 / (1.0 + np.exp(-raw)))


class Scorer:
    """Scores texts in one task and passes over words that bring no weighted feature."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.decoder = Decoder(model.characters)
        self.telling: dict[str, frozenset[str]] = {}
        self.plain = {f.rstrip("*") for f in model.weights}

    def _telling(self, token: str) -> frozenset[str]:
        """The words of a token that share a weighted word or prefix."""
        found = self.telling.get(token)
        if found is None:
            words = self.decoder.token(token)
            found = frozenset(
                w for w in words if w in self.plain or any(w[:n] in self.plain for n in PREFIXES)
            )
            if len(token) <= 40:
                if len(self.telling) >= _CACHE:
                    self.telling.clear()
                self.telling[token] = found
        return found

    def score(self, text: str) -> float:
        return self.model.score(set().union(*map(self._telling, set(self.decoder.tokens(text)))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 25) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps; the bias is not penalised."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x1.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x1.shape[1])
    prior = (y.sum() + 0.5) / (len(y) + 1.0)
    w[-1] = np.log(prior / (1 - prior))
    if not len(y) or y.min() == y.max():
        return w[:-1], float(w[-1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x1 @ w, -30, 30)))
        hessian = (x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(penalty)
        step = np.linalg.solve(hessian, x1.T @ (y - p) - penalty * w)
        w += step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _feature_sets(characters: CharacterModel):
    @F.arrow_udf("array<string>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(characters)
        for texts in batches:
            yield pa.array(
                [sorted(text_features(decoder.distinct_words(t))) for t in plain_texts(texts)], pa.list_(pa.string())
            )

    return features


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    max_train: int = MAX_TRAIN,
    vocabulary: int = VOCABULARY,
    seed: int = 3,
) -> ToxicityModel:
    """Character model from all documents, word weights from a bounded labelled sample.

    The vocabulary holds the words whose documents are most surprisingly toxic. The
    driver sees that vocabulary and, for ``max_train`` rows, which of its words occur.
    """
    characters = CharacterModel.fit(docs)
    sample = training_sample(docs, labels, label, held_out("doc_id", FOLDS, HELD_OUT), max_train, seed)
    sets = sample.select("_order", "doc_id", "label", _feature_sets(characters)("text").alias("features"))
    sets = sets.persist()
    try:
        total, toxic = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
        rate = toxic / max(total, 1)
        z = (F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * (rate * (1 - rate)) + 1.0)
        chosen = (
            sets.select("label", F.explode("features").alias("feature"))
            .groupBy("feature")
            .agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"))
            .where(F.col("toxic") >= MIN_TOXIC_DOCS)
            .orderBy(z.desc(), "feature")
            .limit(vocabulary)
            .select("feature")
        )
        names = sorted(r["feature"] for r in chosen.collect())
        known = F.array(*[F.lit(w) for w in names]) if names else F.array().cast("array<string>")
        rows = (
            sets.select("_order", "label", F.array_intersect("features", known).alias("features"))
            .toPandas()
            .assign(key=lambda d: d["features"].map(lambda w: " ".join(sorted(w))))
            .sort_values(["_order", "key"])
        )
    finally:
        sets.unpersist()
    at = {w: i for i, w in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for r, words in enumerate(rows["features"]):
        x[r, [at[w] for w in words]] = 1.0
    weights, bias = fit_logistic(x, rows["label"].to_numpy(float))
    return ToxicityModel(characters, dict(zip(names, weights.tolist(), strict=True)), bias)


def toxicity_score(model: ToxicityModel, text: str | Column = "text") -> Column:
    """Probability of label 1 as a column; null and empty texts get that of no words."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for texts in batches:
            yield pa.array(map(scorer.score, plain_texts(texts)), pa.float64())

    return score(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Null and empty texts get the probability of a text without listed words; a null id is
    never held out; repeated rows are scored each; an empty table gives no rows; other
    columns of ``docs`` are not read. Whole texts are decoded.
    """
    model = fit_toxicity(docs, labels, max_train=max_train)
    return docs.select(
        "doc_id",
        held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"),
        toxicity_score(model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Rows of ``docs`` scored below the threshold, with all their columns."""
    model = fit_toxicity(docs, labels, max_train=max_train)
    return docs.where(toxicity_score(model) < THRESHOLD)
