"""Sinks. Spark publishes files only when a job commits, so readers never see half-written output."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.session import settings

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package installed

#: Folders of a bucketed table, whatever the number of its keys, and their column.
BUCKETS, BUCKET = 64, "bucket"

# The columns of the report.
REPORT_HEADER = ["Repo", "Makefile", "Status", "Failed Reason?"]


def _spread_out(df: DataFrame, keys: list[str], within: list[str], spread: int) -> DataFrame:
    """Rows gathered by the folder they go to; a folder is cut into up to ``spread`` files, so
    that one with very many rows is not written by one task."""
    return df.repartition(*keys, F.pmod(F.xxhash64(*within), F.lit(spread)))


def bucket_of(keys: list[str], buckets: int = BUCKETS) -> Column:
    """Folder number of a key; readers find the folder of a key with it."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _bucketed(df: DataFrame, keys: list[str], within: list[str], buckets: int, spread: int):
    """A writer of rows in a fixed number of folders by the hash of their keys, which stay columns of the rows; files are dealt evenly to tasks by number."""
    rows = df.withColumn(BUCKET, bucket_of(keys, buckets))
    file = (F.col(BUCKET) * spread + F.pmod(F.xxhash64(*within), F.lit(spread))).cast("int")
    tasks = min(buckets * spread, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartitionById(tasks, file % tasks).write.mode("overwrite").partitionBy(BUCKET)


def matched_functions(matched: DataFrame, path: str, buckets: int = BUCKETS, spread: int = 8) -> None:
    """Matched functions as compressed JSON lines, in buckets by owner and name."""
    _bucketed(matched, ["repo_owner", "repo_name"], ["binary_hash", "func_name"], buckets, spread).json(path, compression="gzip")


def source_corpus(sources: DataFrame, path: str, spread: int = 8) -> None:
    """One record per hash below its owner."""
    kept = sources.select("repo_owner", "repo_name", "sha", "code")
    _spread_out(kept, ["repo_owner"], ["sha"], spread).write.mode("overwrite").partitionBy("repo_owner").parquet(path)


def makefile_report(report: DataFrame, path: str) -> None:
    """CSV with four header columns; the last one is left for the reader to fill in."""
    columns = [F.col("repo"), F.col("dir"), F.col("status"), F.lit(None).cast("string")]
    named = report.select(*[c.alias(h) for c, h in zip(columns, REPORT_HEADER)])
    named.write.mode("overwrite").option("header", "true").option("emptyValue", "").csv(path)


def libraries(names: DataFrame, path: str) -> None:
    """Distinct library names, one per line."""
    names.select(F.col("library").alias("value")).distinct().write.mode("overwrite").text(path)


def decompiled_functions(functions: DataFrame, path: str, buckets: int = BUCKETS, spread: int = 8) -> None:
    """Functions of binaries as compressed JSON lines, in buckets by the hash of the binary."""
    kept = functions.select("sha", "function", "ast", "raw_code")
    _bucketed(kept, ["sha"], ["function", "raw_code"], buckets, spread).json(path, compression="gzip")


def decompiled_lines(lines: DataFrame, path: str, buckets: int = BUCKETS, spread: int = 8) -> None:
    """Raw lines (sha, line_pos, line) as they are, in buckets by the hash of the binary."""
    _bucketed(lines.select("sha", "line_pos", "line"), ["sha"], ["line_pos"], buckets, spread).parquet(path)


#: Files in a folder of ``file_per_row``, and bytes of a batch that a task is handed.
FILES_PER_FOLDER, FILES_BATCH = 2_000, 8 << 20


def _files_of_task(root: str, per_folder: int) -> Callable:
    """Writes (name, content) as files in hidden folders of a task and returns the names of these folders."""

    def write(batches):
        import os
        import uuid

        import pyarrow as pa

        n, mine, folders = 0, uuid.uuid4().hex, []
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                if n % per_folder == 0:
                    folders.append(f"{mine}-{len(folders)}")
                    os.makedirs(f"{root}/.{folders[-1]}")
                with open(f"{root}/.{folders[-1]}/{name.as_py()}-{n}.txt", "wb") as file:
                    file.write((content.as_py() or b"") + b"\n")
                n += 1
        yield pa.RecordBatch.from_pydict({"folder": pa.array(folders, pa.string())})

    return write


def _even(rows: DataFrame) -> DataFrame:
    """The rows as they lie if no task has much more than its share of them, else dealt anew; rows are counted, not read."""
    held = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count").alias("most"), F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first()
    share = 2 * held["n"] // rows.sparkSession.sparkContext.defaultParallelism
    if (held["most"] or 0) <= max(share, FILES_PER_FOLDER):
        return rows
    return rows.repartition(-(-held["n"] // FILES_PER_FOLDER))


def file_per_row(rows: DataFrame, key: str, text: str, path: str, mounted: bool | None = None) -> None:
    """Each row as a text file of its own with ``key=value`` of its whole number in the path; ``path`` must be new.

    On a mounted file system Hadoop starts a process for the permissions of every file and of its checksums, so tasks write there with the calls of the
    system: some files to a folder, whatever their keys. Folders are hidden until the job ends, and then those of the attempts that counted
    get their names. All other stores are written by Spark, which makes a folder of each key.
    """
    spark = rows.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if mounted is None:
        mounted = store.getUri().getScheme() == "file"
    dealt = _even(rows.select(key, text))
    if not mounted:
        writer = dealt.withColumn("part", F.spark_partition_id()).write.partitionBy("part", key)
        # Tasks move their own files into place, so that the driver does not move them one by one.
        writer.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
        return
    store.mkdirs(root)
    name = F.concat(F.lit(f"{key}="), F.coalesce(F.col(key).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
    write = _files_of_task(store.makeQualified(root).toUri().getPath(), FILES_PER_FOLDER)
    with settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(FILES_BATCH)}):
        written = dealt.select(name.alias("name"), F.col(text).cast("binary").alias("content")).mapInArrow(write, "folder string").collect()
    for row in written:
        if not store.rename(hadoop.Path(root, f".{row.folder}"), hadoop.Path(root, row.folder)):
            raise OSError(f"cannot rename {path}/.{row.folder}")
