"""Drive a stream to completion and hand back its output as a table."""

from pyspark.sql import DataFrame

from threadloom.sources.stages import scratch_path


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """Process everything available now into a Parquet table and read it."""
    spark = stream.sparkSession
    out = scratch_path(spark, f"{name}-out")
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, f"{name}-progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
