"""Session settings, and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from typing import Any, TypeVar

from pyspark.sql import DataFrame, SparkSession, functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "mercatura", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can read: the one named by ``spark.checkpoint.dir``.

    Only where that is unset, a master inside this process uses a folder of its warehouse; any other stops.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
            "spark.checkpoint.dir", None
        )
        if named is None:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            named = f"{spark.conf.get('spark.sql.warehouse.dir')}/staged"
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def release(spark: SparkSession) -> None:
    """Delete the tables that this application has staged; what still reads them fails afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _staged.clear()


def new_table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/tables/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write an intermediate table once as Parquet in the shared folder, and read it back."""
    path = new_table_path(df.sparkSession, name)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


T = TypeVar("T")
_staged: dict[tuple[str, str, str], tuple[int, Any]] = {}


def source_state(spark: SparkSession, folder: str) -> int:
    """A number that changes when a Parquet file below ``folder`` is added, removed or written anew."""
    files = (
        spark.read.format("binaryFile")
        .options(pathGlobFilter="*.parquet", recursiveFileLookup=True)
        .load(folder)
        .select("path", "modificationTime", "length")
    )
    state = files.agg(F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)"))).first()[0]
    return int(state or 0)


def share(spark: SparkSession, scope: str, name: str, build: Callable[[], T]) -> T:
    """A written table, or its name, that queries over the same files share; built anew when the files below
    ``scope`` change."""
    key = (spark.sparkContext.applicationId, scope, name)
    state = source_state(spark, scope)
    if key not in _staged or _staged[key][0] != state:
        _staged[key] = (state, build())
    return _staged[key][1]


def stage_once(
    spark: SparkSession, scope: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    return share(spark, scope, name, lambda: stage(build(), name))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so a lost executor never restarts the plan before it."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
