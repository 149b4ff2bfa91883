"""Exact global and per-stratum ranks that never sort a whole stratum in one task."""

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType

from threadloom.sources.stages import cut_lineage

HASH_BUCKET_DIGITS = 4
BUCKET_ROWS = 200_000  # that one task sorts


def sampling_hash(id_col: str, seed) -> Column:
    """Portable pseudo-random key of a row; rows without an id share the key of an empty one."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")))


def values_hash(df: DataFrame, seed) -> Column:
    """Second key of a row, over all its values (maps aside): tells rows of one id, or of none, apart."""
    columns = [F.col(f.name) for f in df.schema if not isinstance(f.dataType, MapType)]
    return F.md5(F.concat(F.xxhash64(*columns).cast("string"), F.lit(f":{seed}")))


def _with_bucket(df: DataFrame, hashed: Column) -> DataFrame:
    return df.withColumn("_hash", hashed).withColumn(
        "_bucket", F.substring("_hash", 1, HASH_BUCKET_DIGITS)
    )


def _bucket_offsets(keyed: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Rows per hash bucket, rows before it and rows in all, per stratum.

    A combine-before-shuffle count of at most 65,536 rows per stratum.
    """
    strata = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = strata.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.groupBy(*by, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(strata))
    )


def hash_rank(df: DataFrame, id_col: str, seed, rank_col: str = "_rank") -> DataFrame:
    """1-based rank of every row in hash order; rows of one hash are ordered by their values.

    Offsets come from counts per hash prefix, so only rows sharing a prefix are
    sorted together and no task sees more than a sliver of the table. Where a prefix has
    too many rows, because they share an id or the table is huge, rows are range-partitioned by both hashes.
    """
    keyed = _with_bucket(df, sampling_hash(id_col, seed)).withColumn("_values", values_hash(df, seed))
    offsets = _bucket_offsets(keyed, ()).select("_bucket", "_before", "_n")
    if (offsets.agg(F.max("_n")).first()[0] or 0) > BUCKET_ROWS:
        ranked = zip_with_index(keyed, ["_hash", "_values"], rank_col).withColumn(rank_col, F.col(rank_col) + 1)
        return ranked.drop("_hash", "_bucket", "_values")
    inside = Window.partitionBy("_bucket").orderBy("_hash", "_values")
    return (
        # At most 65,536 offsets: broadcast.
        keyed.join(F.broadcast(offsets.drop("_n")), "_bucket")
        .withColumn(rank_col, F.col("_before") + F.row_number().over(inside))
        .drop("_hash", "_bucket", "_before", "_values")
    )


def hash_cuts(df: DataFrame, hashed: Column, position: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """``*by, cut, below, at, position``: the hash at 1-based ``position`` of the hash order of each
    stratum, and how many rows lie below and at it.

    ``position`` may use ``_total``, the rows of the stratum; a stratum with fewer
    rows has no cut. ``by`` should name a listed few strata: one row each is broadcast. Only what the
    hash and the strata need is read, and of the one bucket per stratum that holds the
    position rows are counted per hash, so rows that share one never meet.
    """
    keyed = _with_bucket(df, hashed).select(*by, "_hash", "_bucket")
    offsets = _bucket_offsets(keyed, by).withColumn("_position", position)
    holding = offsets.where(
        (F.col("_before") < F.col("_position"))
        & (F.col("_position") <= F.col("_before") + F.col("_n"))
    ).select(*by, "_bucket", "_before", "_position")
    counted = (
        keyed.join(F.broadcast(holding), [*by, "_bucket"])
        .groupBy(*by, "_bucket", "_before", "_position", "_hash")
        .agg(F.count(F.lit(1)).alias("_at"))
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy("_hash")
    return (
        counted.withColumn("_up_to", F.col("_before") + F.sum("_at").over(inside))
        .where((F.col("_up_to") >= F.col("_position")) & (F.col("_up_to") - F.col("_at") < F.col("_position")))
        .select(
            *by,
            F.col("_hash").alias("cut"),
            (F.col("_up_to") - F.col("_at")).alias("below"),
            F.col("_at").alias("at"),
            F.col("_position").alias("position"),
        )
    )


def hash_cut(
    df: DataFrame, id_col: str, seed, position: Column, by: tuple[str, ...] = ()
) -> DataFrame:
    """``*by, cut`` of ``hash_cuts`` in the order of the sampling hash.

    Selecting ``hash <= cut`` samples ``position`` rows with a plain filter, so the rows
    themselves are never sorted or shuffled; rows that share the hash of the cut are all selected.
    """
    return hash_cuts(df, sampling_hash(id_col, seed), position, by).select(*by, "cut")


def zip_with_index(df: DataFrame, order: list, index_col: str = "index") -> DataFrame:
    """0-based position of every row in a total order, without a one-task sort.

    The rows are range-partitioned and sorted, positions inside a partition come
    from the partition-local row number, and the partition offsets (one row per
    partition) are broadcast. Range boundaries are sampled, so the sorted rows
    are checkpointed once and both steps read that copy.
    """
    local = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ordered = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_local", local)
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    # One row per partition of `ordered`: bounded by the partition count.
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(index_col, F.col("_before") + F.col("_local"))
        .drop("_part", "_local", "_before")
    )


def topk_per_group(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """First ``k`` rows of each group.

    Spark keeps only k rows per group on the map side (WindowGroupLimit), so a
    hot group costs one task ``k`` rows per input partition.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
