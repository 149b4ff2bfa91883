"""Stage tables, scratch locations and lineage cuts."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without the
    setting (a test run) gets a folder of its own, which is removed when Python exits; on
    several machines a folder of one of them would be of no use.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="threadloom-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    context.setCheckpointDir(root)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables next to the checkpoints."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def write_stage(df: DataFrame, path: str) -> None:
    """Write an intermediate table; an existing one is never overwritten."""
    df.write.mode("errorifexists").parquet(path)


def stage_or_load(spark: SparkSession, path: str, build) -> DataFrame:
    """Reuse the finished stage at ``path``, or build, write and read it."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        # A crashed attempt leaves files without the marker; they are replaced.
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def observe_stage(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills during whatever action runs next."""
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def stage_counts(spark: SparkSession, stages: dict[str, DataFrame | Observation]) -> DataFrame:
    """Rows per named stage as one ``stage, rows`` table.

    A stage that was observed while it was written costs nothing here; a table is counted.
    """

    def one(name: str, stage: DataFrame | Observation) -> DataFrame:
        if isinstance(stage, Observation):
            counted = spark.range(1).select(F.lit(stage.get["rows"]).cast("long").alias("rows"))
        else:
            counted = stage.agg(F.count(F.lit(1)).alias("rows"))
        return counted.select(F.lit(name).alias("stage"), "rows")

    first, *rest = (one(name, stage) for name, stage in stages.items())
    for extra in rest:
        first = first.unionByName(extra)
    return first


def preview(df: DataFrame, order_by, rows: int = 5) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order_by).limit(rows)
