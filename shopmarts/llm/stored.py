"""Intermediate tables in the session's shared folder: they cut lineage and outlive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopmarts.session import scratch_path

BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Have the session hand texts to Python in batches of ``BATCH_BYTES`` (and at most 2,000 rows), so what a
    worker holds besides its block does not depend on the rows' length; a smaller setting of the user's stays."""
    for name, most in ((_BATCH_CONF, BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", 2000)):
        current = spark.conf.get(name)
        if not current.removesuffix("b").isdigit() or not 0 < int(current.removesuffix("b")) <= most:
            spark.conf.set(name, str(most))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet below the shared folder, and read back with its schema."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
