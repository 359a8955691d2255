"""Readers of the corpus inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow import schemas
from corpusflow.operators import rollups
from corpusflow.session import settings, settle, working_path
from corpusflow.sources import writers

#: Up to so many file splits, their line counts are sent to all tasks; beyond it, lines and counts are joined by a shuffle.
BROADCAST_SPLITS = 100_000
#: Files that are listed and read at a time.
FILES_AT_ONCE = 20_000
_HASH_IN_PATH = r"(?:/|sha=)([0-9a-zA-Z]+)(?:\.jsonl|/[^/]*)$"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with a dense zero-based index in the order of the files and their content.

    Row numbers inside a file split come from the one scan, which writes them down with the lines: a second scan could be split
    otherwise. Only the small table of splits is sorted, and no line is shuffled.
    """
    raw = settle(spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    ))
    splits = raw.groupBy("_file", "_start").agg(F.min("_row").alias("_first"), F.count("*").alias("_lines"))
    # One row per file split.
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_file", "_start", "_first", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_before"))
    index = F.col("_row") - F.col("_first") + F.col("_before")
    return raw.join(F.broadcast(offsets) if offsets.count() <= BROADCAST_SPLITS else offsets, ["_file", "_start"]).select(index.alias("idx"), "value")


def repo_list(spark: SparkSession, path: str) -> DataFrame:
    return lines(spark, path).select("idx", F.col("value").alias("line"))


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    return lines(spark, path).select(F.col("idx").alias("line_no"), F.col("value").alias("line"))


def repo_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REPO_STATE).parquet(path)


def binary_states(spark: SparkSession, path: str) -> DataFrame:
    """Binary state; files written before owners were stored give null owners."""
    return spark.read.schema(schemas.BINARY_STATE).parquet(path)


def match_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MATCH_STATE).parquet(path)


def decompiled_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw JSON lines with the hash of their binary, from ``<hash>.jsonl`` files or ``sha=<hash>`` folders.

    Lines stay undecoded, so that they can be filtered by function name first. ``line_pos`` orders the
    lines of a file.
    """
    file = F.col("_metadata.file_path")
    raw = spark.read.option("recursiveFileLookup", "true").text(path)
    return raw.filter("value <> ''").select(
        F.regexp_extract(file, _HASH_IN_PATH, 1).alias("sha"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
        ).alias("line_pos"),
        F.col("value").alias("line"),
    )


def _of_keys(rows: DataFrame, buckets: int, keys: dict[str, str] | None) -> DataFrame:
    """Rows of a bucketed table, of one key only the folder of its bucket."""
    if keys:
        here = writers.bucket_of([F.lit(v) for v in keys.values()], buckets)
        number = rows.sparkSession.range(1).select(here).first()[0]
        rows = rows.filter(F.col(writers.BUCKET) == number)
        for name, wanted in keys.items():
            rows = rows.filter(F.col(name) == wanted)
    return rows.drop(writers.BUCKET)


def stored_lines(spark: SparkSession, path: str, sha: str | None = None, buckets: int = writers.BUCKETS) -> DataFrame:
    """Raw lines (sha, line_pos, line) that ``writers.decompiled_lines`` wrote, of all binaries or of one; empty lines are left out."""
    rows = spark.read.schema(f"sha string, line_pos {schemas.LINE_POS}, line string, {writers.BUCKET} int").parquet(path)
    return _of_keys(rows, buckets, sha and {"sha": sha}).filter("line <> ''")


def stored_functions(spark: SparkSession, path: str, sha: str | None = None, buckets: int = writers.BUCKETS) -> DataFrame:
    """Functions that ``writers.decompiled_functions`` wrote, of all binaries or of one."""
    rows = spark.read.schema(f"sha string, function string, ast string, raw_code string, {writers.BUCKET} int").json(path)
    return _of_keys(rows, buckets, sha and {"sha": sha})


def stored_matches(spark: SparkSession, path: str, fields: str, repo: tuple[str, str] | None = None, buckets: int = writers.BUCKETS) -> DataFrame:
    """Records that ``writers.matched_functions`` wrote, of all repositories or of one (owner, name)."""
    rows = spark.read.schema(f"repo_owner string, repo_name string, {fields}, {writers.BUCKET} int").json(path)
    return _of_keys(rows, buckets, repo and dict(zip(("repo_owner", "repo_name"), repo, strict=True)))


def library_log(spark: SparkSession, path: str) -> DataFrame:
    return rollups.library_words(spark.read.text(path))


def _folders(spark: SparkSession, path: str) -> list[str]:
    """What lies directly below a root, without hidden names; the root itself where nothing does."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for top in store.globStatus(root) or []:
        prefix = top.getPath().toString().rstrip("/") + "/"
        if top.isDirectory():
            # One call for all names; none of them holds a slash, so the prefix parts them.
            listed = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(hadoop.FileUtil.stat2Paths(store.listStatus(top.getPath())))[1:-1]
            names = listed.removeprefix(prefix).split(f",{prefix}") if listed else []
            found += [prefix + n for n in names if not n.startswith(".") and ("=" in n or not n.startswith("_"))]
        else:
            found.append(prefix[:-1])
    return found


def _in_steps(spark: SparkSession, path: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``make`` makes of the files below a root (path, modificationTime, length, content), written once.

    Folders of the root are read some at a time, so that the driver holds the names of about ``FILES_AT_ONCE`` files, however many there are; small
    files are read many to a task. ``make`` works on each file by itself.
    """
    folders, step = _folders(spark, path), 1
    made = working_path(spark, "files")
    tasks = 4 * spark.sparkContext.defaultParallelism
    frugal = {
        "spark.sql.files.openCostInBytes": str(128 << 10), "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks),
        "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
    }
    with settings(spark, frugal):
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        if folders:
            reader = reader.option("__globPaths__", "false")
        else:
            folders = [path]
        while folders:
            some, folders = folders[:step], folders[step:]
            found = reader.load(some)
            rows = make(found)
            rows.write.mode("append").parquet(made)
            step = max(1, min(8 * step, step * FILES_AT_ONCE // max(1, len(found._jdf.inputFiles()))))
    return spark.read.schema(rows.schema).parquet(made)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Every (dir, file) below a root; the content column is not read."""
    plain = F.regexp_replace("path", "^file:/+", "/")
    return _in_steps(spark, path, lambda found: found.select(
        F.regexp_replace(plain, "/[^/]*$", "").alias("dir"), F.substring_index(plain, "/", -1).alias("file"),
        "length", F.col("modificationTime").alias("modified"),
    ))


def binary_files(spark: SparkSession, path: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``make`` makes of files (path, length, content), each by itself; contents are not kept."""
    return _in_steps(spark, path, lambda found: make(found.select("path", "length", "content")))


def source_files(spark: SparkSession, path: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``make`` makes of whole source files as text (path, code), each by itself; files that are not valid text are left out."""
    return binary_files(spark, path, lambda found: make(rollups.decodable(found.select("path", "content"), "content").withColumnRenamed("content", "code")))


def repo_results(spark: SparkSession, path: str, repos: DataFrame) -> DataFrame:
    """Result of each repository and its number of Makefiles; a missing or unreadable result file counts as an empty list.

    Lists are counted before the join, so that a reader of the number moves no list.
    """
    stored = (
        spark.read.schema(schemas.REPO_RESULT).option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true")
        .option("recursiveFileLookup", "true").parquet(path)
    )
    empty = F.array().cast(f"array<{schemas.MAKEFILE}>")
    counted = stored.withColumn("num_makefiles", F.size("makefiles").cast("bigint"))
    joined = repos.join(counted, ["repo_owner", "repo_name"], "left")
    return joined.withColumns({"makefiles": F.coalesce("makefiles", empty), "num_makefiles": F.coalesce("num_makefiles", F.lit(0).cast("bigint"))})


def untracked(listings: DataFrame, keys: list[str], output: Column) -> DataFrame:
    """One row per untracked file of each listing."""
    from corpusflow.functions.names import untracked_names

    return listings.select(*keys, F.explode(untracked_names(output)).alias("file"))


def estimated_count(spark: SparkSession, path: str) -> DataFrame:
    """Number of rows as the file footers state it; no column is read.

    The aggregate goes down to the files, which the file source of the second version does; the settings hold for a session of its own.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path).agg(F.count("*").alias("n"))
