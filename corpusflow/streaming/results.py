"""Processing results as they arrive: states, running totals and libraries kept up to date by micro-batches."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusflow.operators.ordered import latest
from corpusflow.operators.state import MATCH_COUNTERS, REPO_KEY, add_binaries, add_match_results, write_snapshot
from corpusflow.plans.build_run import apply_results

TOTALS = ["results", "funcs_matched", "without_ast"]
REPOS, BINARIES, MATCHES = "state", "binaries", "matches"
KEYS = {REPOS: REPO_KEY, BINARIES: ["sha"], MATCHES: REPO_KEY}
GIVEN = {BINARIES: "sha", MATCHES: "files_found"}  # a result without it does not touch that state
KEPT_VERSIONS = 3
WHOLE_EVERY = 32  # versions in between hold only the rows that their batch has touched


def _whole(version: int) -> int:
    """The last version up to this one that holds the whole state."""
    return version - version % WHOLE_EVERY


class ResultFold:
    """Folds batches of results into versions of the states below ``base``: repositories and, if given, binaries and matches.

    Version n+1 is made from version n and batch n. A folder holds the rows whose keys its batch has touched, so what is written grows with the batch;
    every ``WHOLE_EVERY`` versions a folder holds the whole state. A version is the last row of each key since the whole one before it. A batch
    that runs again after a failure reads the same version and replaces the same folder, so the fold is idempotent. The last few versions stay.
    """

    def __init__(self, spark: SparkSession, base: str, initial: DataFrame, binaries: DataFrame | None = None, matches: DataFrame | None = None) -> None:
        self.spark = spark
        self.base = base
        self.kinds = {k: s for k, s in {REPOS: initial, BINARIES: binaries, MATCHES: matches}.items() if s is not None}
        for kind, state in self.kinds.items():
            if not self._exists(f"{base}/{kind}/v={0:012d}/_SUCCESS") and not self._versions(kind):
                write_snapshot(state, f"{base}/{kind}", 0)

    def _files(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        hadoop, files = self._files(path)
        return files.exists(hadoop)

    def _versions(self, kind: str) -> list[int]:
        """The versions that were written completely."""
        if not self._exists(f"{self.base}/{kind}"):
            return []
        hadoop, files = self._files(f"{self.base}/{kind}")
        names = [f.getPath().toString() for f in files.listStatus(hadoop)]
        return sorted(int(n.rsplit("v=", 1)[1]) for n in names if self._exists(n + "/_SUCCESS"))

    def latest_version(self, kind: str = REPOS) -> int:
        return self._versions(kind)[-1]

    def state(self, version: int, kind: str = REPOS, touched: DataFrame | None = None) -> DataFrame:
        """The state of a version, or only its rows whose keys are touched."""
        paths = [f"{self.base}/{kind}/v={v:012d}" for v in range(_whole(version), version + 1)]
        keys = KEYS[kind]
        rows = self.spark.read.option("basePath", f"{self.base}/{kind}").parquet(*paths)
        columns = [c for c in rows.columns if c != "v"]
        if touched is not None:
            rows = rows.join(touched, keys, "left_semi")
        if len(paths) > 1:
            rows = latest(rows, keys, F.col("v"), [c for c in columns if c not in keys])
        return rows.select(*columns)

    def _next(self, kind: str, batch: DataFrame, version: int) -> DataFrame:
        """What the next version writes: the touched rows, or the whole state when its turn has come."""
        keys = KEYS[kind]
        batch = batch.filter(F.col(GIVEN[kind]).isNotNull()) if kind in GIVEN else batch
        touched = batch.select(*keys).dropna().distinct()
        updated = self._updated(kind, self.state(version, kind, touched), batch)
        if _whole(version + 1) != version + 1:
            return updated
        return self.state(version, kind).join(touched, keys, "left_anti").unionByName(updated)

    def latest(self, kind: str = REPOS) -> DataFrame:
        return self.state(self.latest_version(kind), kind)

    def _forget(self, kind: str, before: int) -> None:
        for version in self._versions(kind):
            if version < before:
                hadoop, files = self._files(f"{self.base}/{kind}/v={version:012d}")
                files.delete(hadoop, True)

    def totals(self) -> DataFrame:
        """Running totals over the batches; one row per batch was written."""
        return self.spark.read.parquet(f"{self.base}/totals").agg(
            *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in TOTALS]
        )

    def libraries(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/libraries").select("library").distinct()

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Bring all states up to date with one batch, which is read once."""
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for kind in self.kinds:
                write_snapshot(self._next(kind, batch, batch_id), f"{self.base}/{kind}", batch_id + 1)
                self._forget(kind, _whole(max(0, batch_id + 2 - KEPT_VERSIONS)))
            sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in TOTALS[1:]]
            write_snapshot(batch.agg(F.count("*").alias("results"), *sums), f"{self.base}/totals", batch_id)
            if "library" in batch.columns:
                named = batch.select("library").filter("library is not null").distinct()
                write_snapshot(named, f"{self.base}/libraries", batch_id)
        finally:
            batch.unpersist()

    def _updated(self, kind: str, state: DataFrame, batch: DataFrame) -> DataFrame:
        if kind == BINARIES:
            return add_binaries(state, batch.select(*REPO_KEY, "sha", "success", "seq"))
        if kind == MATCHES:
            return add_match_results(state, batch.select(*REPO_KEY, *MATCH_COUNTERS, "seq"))
        return apply_results(state, batch)


def start(source: DataFrame, fold: ResultFold, available_now: bool = True) -> StreamingQuery:
    """Run the fold on a stream; with ``available_now`` it stops after the data that is there."""
    writer = source.writeStream.foreachBatch(fold.apply).option("checkpointLocation", f"{fold.base}/progress")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
