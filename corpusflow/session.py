"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: dict[str, list[str]] = {}
_LOCAL_ROOT: dict[str, tempfile.TemporaryDirectory] = {}  # removed when the program ends


def build_session(master: str | None = None, app: str = "corpusflow", **conf: str) -> SparkSession:
    """A session with adaptive execution on; cluster settings given elsewhere are left alone."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def working_root(spark: SparkSession) -> str:
    """Folder shared by all executors: ``spark.checkpoint.dir`` or the checkpoint folder of the context.

    Only a local master may fall back to a temporary folder of the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    app_id = spark.sparkContext.applicationId
    if app_id not in _LOCAL_ROOT:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _LOCAL_ROOT[app_id] = tempfile.TemporaryDirectory(prefix="corpusflow-", ignore_cleanup_errors=True)
    return _LOCAL_ROOT[app_id].name


def working_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{working_root(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings for what runs inside."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def release(spark: SparkSession) -> int:
    """Delete what this application has written below the shared folder so far, and return the number of paths.

    To be called when the results made from these tables have been written or are not needed any more.
    """
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    return len(paths)


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows once as a table in the shared folder and read them from there.

    Every later use sees the same rows, reads only the columns it needs and knows the size of the table.
    """
    spark = df.sparkSession
    path = working_path(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
