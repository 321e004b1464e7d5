"""What several operators of this subpackage share."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

#: Folder that the package was imported from.
SOURCE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows and bytes of a table that one Python worker holds at a time.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, as one row may hold a very long text.

    Workers look for this package also where the driver found it, so a source tree works without installation.
    Products of matrices run on one thread, as every core has a task of its own.
    """
    environment = spark.sparkContext.environment
    environment.setdefault("OPENBLAS_NUM_THREADS", "1")
    # what a worker frees goes back to the system, as it is kept for later tasks
    environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    environment.setdefault("MALLOC_ARENA_MAX", "1")
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if SOURCE not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, SOURCE]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
