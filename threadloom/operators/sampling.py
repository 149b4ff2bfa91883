"""Deterministic sampling, shuffling and splitting."""

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.operators.ranking import hash_cut, hash_cuts, hash_rank, sampling_hash, values_hash
from threadloom.sources.stages import cut_lineage


# Sorts after every hash: "no cut" selects everything.
NO_CUT = "g"


def _selected(id_col: str, seed, cut: Column) -> Column:
    return sampling_hash(id_col, seed) <= F.coalesce(cut, F.lit(NO_CUT))


def first_by_hash(df: DataFrame, id_col: str, seed, position: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``_chosen``: of each stratum exactly ``position`` rows, the first in hash order, or all if it has fewer.

    Rows are marked by comparing their hash with the cut. Rows that share the cut's hash, because they have one id or
    none, are cut again in the order of their values; rows equal in all values replace each other, so so
    many of them are marked. ``by`` should name a listed few strata; the driver holds a few numbers of each.
    """
    hashed, second = sampling_hash(id_col, seed), values_hash(df, seed)

    def of_stratum(values: dict, default) -> Column:
        if not by:
            return F.lit(values.get((), default))
        listed = [x for key, value in values.items() for x in (F.lit("\0".join(map(str, key))), F.lit(value))]
        stratum = F.concat_ws("\0", *[F.col(c).cast("string") for c in by])
        return F.coalesce(F.create_map(*listed)[stratum], F.lit(default)) if listed else F.lit(default)

    def cuts(rows: DataFrame, order: Column, at: Column) -> dict:
        return {tuple(r[c] for c in by): r for r in hash_cuts(rows, order, at, by).collect()}

    first = cuts(df, hashed, position)
    cut = of_stratum({key: r["cut"] for key, r in first.items()}, NO_CUT)
    wanted = {key: r["position"] - r["below"] for key, r in first.items()}
    tied = {key: n for key, n in wanted.items() if n < first[key]["at"]}
    if not tied:
        return df.withColumn("_chosen", hashed <= cut)
    is_tied = (hashed == cut) & (of_stratum(tied, -1) >= 0)
    again = cuts(df.where(is_tied), second, of_stratum(tied, -1))
    inner = of_stratum({key: r["cut"] for key, r in again.items()}, NO_CUT)
    marked = df.withColumn("_chosen", F.when(is_tied, second <= inner).otherwise(hashed <= cut))
    equal = {key: r for key, r in again.items() if r["position"] - r["below"] < r["at"]}
    if not equal:
        return marked
    is_equal = is_tied & (second == inner) & (of_stratum(dict.fromkeys(equal, 1), 0) == 1)
    one = df.where(is_equal).dropDuplicates(list(by)) if by else df.where(is_equal).limit(1)
    number = of_stratum({key: r["at"] for key, r in equal.items()}, 0)
    most = of_stratum({key: r["position"] - r["below"] for key, r in equal.items()}, 0)
    copies = one.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), number.cast("long"))))
    return marked.where(~is_equal).unionByName(copies.withColumn("_chosen", F.col("_copy") <= most).drop("_copy"))


def sample_n(df: DataFrame, n: int | None, seed, id_col: str) -> DataFrame:
    """Exactly ``n`` rows without replacement; everything if n is unset or too large.

    Rows are selected by a filter on their hash. Rows that share the hash of the cut, such as those
    of one id or of none, are told apart by their values.
    """
    if not n:
        return df
    cut = hash_cut(df, id_col, seed, F.lit(n)).scalar()
    keyed = sampling_hash(id_col, seed)
    counts = df.agg(
        F.count(F.when(keyed < F.coalesce(cut, F.lit(NO_CUT)), 1)).alias("below"),
        F.count(F.when(keyed == cut, 1)).alias("at"),
    ).first()
    if counts["below"] + counts["at"] <= n:
        return df.where(_selected(id_col, seed, cut))
    tied = df.where(keyed == cut).orderBy(F.to_json(F.struct(*df.columns))).limit(n - counts["below"])
    return df.where(keyed < cut).unionByName(tied)


def stratum_counts(df: DataFrame, strata_col: str, values: list[str]) -> DataFrame:
    """Rows available per requested stratum, zero included."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(v,) for v in values], f"{strata_col} string")
    found = (
        df.where(F.col(strata_col).isin(values))
        .groupBy(strata_col)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return wanted.join(found, strata_col, "left").select(
        strata_col, F.coalesce("rows", F.lit(0)).alias("rows")
    )


def unused_rows(df: DataFrame, used: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` that are not in ``used``."""
    return df.join(used.select(id_col), id_col, "left_anti")


def concat_samples(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def stratified_quota_sample(
    df: DataFrame, strata_col: str, values: list[str], total: int, seed, id_col: str
) -> DataFrame:
    """Even quota per listed stratum, topped up from the unused rows, then shuffled.

    Adds ``sample_idx``, the 0-based position after the shuffle. The driver holds
    a few numbers per listed stratum; the rows are selected by a filter. Rows without an id, or of a
    repeated one, are rows like any other: quotas are exact.
    ``df`` is read several times, so an expensive input should be staged first.
    """
    listed = df.where(F.col(strata_col).isin(values))
    quota = total // len(values)
    rows = {r[strata_col]: r["count"] for r in listed.groupBy(strata_col).count().collect()}
    if quota:
        marked = first_by_hash(listed, id_col, seed, F.lit(quota), (strata_col,))
    else:
        marked = listed.withColumn("_chosen", F.lit(False))
    chosen = marked.where("_chosen").drop("_chosen")
    missing = total - sum(min(n, quota) for n in rows.values())
    if missing > 0:
        spare = marked.where(~F.col("_chosen")).drop("_chosen")
        extra = first_by_hash(spare, id_col, f"{seed}:extra", F.lit(missing))
        chosen = chosen.unionByName(extra.where("_chosen").drop("_chosen"))
    # At most `total` rows; ranking them reads them twice.
    return shuffle_rows(cut_lineage(chosen), f"{seed}:shuffle", id_col, "sample_idx")


def shuffle_rows(df: DataFrame, seed, id_col: str, index_col: str = "shuffle_idx") -> DataFrame:
    """Random permutation as a fresh 0-based index."""
    return hash_rank(df, id_col, seed, index_col).withColumn(index_col, F.col(index_col) - 1)


def train_val_split(df: DataFrame, seed, id_col: str) -> DataFrame:
    """80/20 split after a seeded shuffle: exactly ceil(n/5) rows become ``val``."""
    marked = first_by_hash(df, id_col, seed, F.expr("(_total + 4) div 5"))
    return marked.withColumn("split", F.when(F.col("_chosen"), "val").otherwise("train")).drop("_chosen")


def hash_split(df: DataFrame, seed, id_col: str, val_share: float = 0.2) -> DataFrame:
    """Shuffle-free split: every row decides by its own hash, sizes are approximate."""
    cut = int(val_share * (1 << 32))
    position = F.conv(F.substring(sampling_hash(id_col, seed), 1, 8), 16, 10).cast("long")
    return df.withColumn("split", F.when(position < cut, "val").otherwise("train"))
