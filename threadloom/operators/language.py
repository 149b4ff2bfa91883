"""Language labels from character-trigram profiles."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from threadloom.sources.stages import cut_lineage

# Profiles estimated to stay below this are held by every task.
BROADCAST_BYTES = 128 << 20
ROW_BYTES = 80
GRAM = r"(?s)(?=(.{3}))."
# Scores are compared after rounding, so that the order of sums does not decide.
SCORE_DIGITS = 6


def trigrams(text: Column) -> Column:
    """All overlapping three-character pieces of the whole lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(GRAM), F.lit(1))


def _gram_counts(texts: DataFrame, key: str, text_col: str) -> DataFrame:
    return (
        texts.select(key, F.explode(trigrams(F.col(text_col))).alias("gram"))
        .groupBy(key, "gram")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _codes(text: str) -> np.ndarray:
    """One integer per trigram: three code points of 21 bits."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    return (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]


@dataclass
class LanguageProfiles:
    """``gram, lang, gain``: how much likelier than an unseen one a trigram is in a language that has it,
    and ``lang, unseen``: the log-probability of an unseen trigram."""

    gains: DataFrame
    unseen: DataFrame

    def predict(self, texts: DataFrame, id_col: str | list[str], text_col: str = "text") -> DataFrame:
        """``id, language`` for every row, or ``language`` beside several columns; a text without trigrams gets NULL.

        A profile of checked size is held by every task, which counts the trigrams of a text
        on the spot. A larger one is joined to trigram counts per text.
        """
        id_cols = [id_col] if isinstance(id_col, str) else list(id_col)
        rows, grams = self.gains.agg(F.count(F.lit(1)), F.countDistinct("gram")).first()
        # In place the profile is a full matrix of trigrams and languages.
        if max(rows * ROW_BYTES, grams * self.unseen.count() * 8) <= BROADCAST_BYTES:
            return self._predict_in_place(texts, id_cols, text_col)
        return self._predict_by_join(texts, id_cols, text_col)

    def _predict_in_place(self, texts: DataFrame, id_cols: list[str], text_col: str) -> DataFrame:
        rows = self.gains.toPandas()
        unseen = self.unseen.orderBy("lang").toPandas()
        langs = unseen["lang"].tolist()
        codes, gram_of = np.unique(
            np.asarray([_codes(g)[0] for g in rows["gram"]], np.int64), return_inverse=True
        )
        gains = np.zeros((len(codes), len(langs)))
        gains[gram_of, rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int)] = rows["gain"]
        shared = texts.sparkSession.sparkContext.broadcast(
            (codes, gains, unseen["unseen"].to_numpy(float), langs)
        )

        @F.arrow_udf(T.StringType())
        def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known, gains, unseen, langs = shared.value
            for batch in batches:
                out = []
                for text in batch.to_pylist():
                    codes = _codes(text) if text and langs else ()
                    if not len(codes):
                        out.append(None)
                        continue
                    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                    at, times = np.unique(at[known[at] == codes], return_counts=True)
                    score = np.round(times @ gains[at] + len(codes) * unseen, SCORE_DIGITS)
                    # Of equal scores the language that sorts last, as in the join.
                    out.append(langs[len(langs) - 1 - int(np.argmax(score[::-1]))])
                yield pa.array(out, pa.string())

        return texts.select(*id_cols, label(F.lower(F.col(text_col))).alias("language"))

    def _predict_by_join(self, texts: DataFrame, id_cols: list[str], text_col: str) -> DataFrame:
        """Languages that have a trigram of the text are scored, besides the one with the likeliest
        unseen trigram, which no other language without a hit can surpass."""
        # Every row is a text of its own, also those of null and repeated ids.
        keyed = cut_lineage(texts.select(*dict.fromkeys([*id_cols, text_col])).withColumn("_row", F.monotonically_increasing_id()))
        pieces = keyed.select("_row", F.explode(trigrams(F.col(text_col))).alias("gram"))
        counted = pieces.groupBy("_row", "gram").agg(F.count(F.lit(1)).alias("n"))
        totals = counted.groupBy("_row").agg(F.sum("n").alias("total"))
        hits = (
            counted.join(self.gains, "gram")
            .groupBy("_row", "lang")
            .agg(F.sum(F.col("n") * F.col("gain")).alias("gain"))
        )
        likeliest = self.unseen.agg(F.max(F.struct("unseen", "lang"))["lang"].alias("lang"))
        others = totals.select(
            "_row", likeliest.scalar().alias("lang"), F.lit(0.0).alias("gain")
        )
        score = F.round(F.col("gain") + F.col("total") * F.col("unseen"), SCORE_DIGITS)
        best = (
            hits.unionByName(others)
            .groupBy("_row", "lang")
            .agg(F.sum("gain").alias("gain"))
            .join(self.unseen, "lang")
            .join(totals, "_row")
            .groupBy("_row")
            .agg(F.max(F.struct(score.alias("score"), "lang"))["lang"].alias("language"))
        )
        return keyed.join(best, "_row", "left").select(*id_cols, "language")


def fit_language_profiles(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang"
) -> LanguageProfiles:
    """Add-one-smoothed trigram log-probabilities per language, for any number of languages.

    The texts are read once; the counts per language and trigram are kept as a checkpoint, and
    totals stay tables.
    """
    counts = cut_lineage(
        _gram_counts(labelled.where(F.col(lang_col).isNotNull()), lang_col, text_col)
    )
    vocabulary = counts.agg(F.countDistinct("gram")).scalar()
    sizes = counts.groupBy(F.col(lang_col).alias("lang")).agg(F.sum("n").alias("total"))
    unseen = sizes.select("lang", (-F.ln(F.col("total") + vocabulary)).alias("unseen"))
    # ln((n + 1) / size) - ln(1 / size)
    gains = counts.select("gram", F.col(lang_col).alias("lang"), F.ln(F.col("n") + 1).alias("gain"))
    return LanguageProfiles(gains, unseen)


def english_filter(
    texts: DataFrame, profiles: LanguageProfiles, text_col: str = "text", language: str = "en"
) -> DataFrame:
    """Rows whose detected language is ``language``; undetectable rows go.

    Every row is judged by its own text, whatever its id.
    """
    other = [c for c in texts.columns if c != "language"]
    kept = profiles.predict(texts.select(F.struct(*texts.columns).alias("_row_values"), *other), ["_row_values"], text_col)
    return kept.where(F.col("language") == language).select("_row_values.*")
