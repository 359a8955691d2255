"""Analysis of build-run logs: series, snapshots, run comparison and failure reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import loglines, names
from corpusflow.functions.rows import with_once
from corpusflow.operators.ordered import latest, position_in_key, spread_where_few

SNAPSHOT_TAGS = ["n_success", "n_total"]
SERIES_TAGS = ["n_partial", "n_binaries", "n_total"]
MAX_SAMPLED_MAKEFILES = 50


def snapshot(log: DataFrame) -> DataFrame:
    """Counts of each repository by its last line; a line without Makefiles sets them to zero."""
    summary = loglines.groups(F.col("line"), loglines.SUMMARY, len(loglines.SUMMARY_FIELDS))
    nothing = loglines.groups(F.col("line"), loglines.NO_MAKEFILES, len(loglines.NO_MAKEFILES_FIELDS))
    parsed = with_once(spread_where_few(log.select("line_no", "line"), "line_no"), s=summary, n=nothing).filter("s is not null or n is not null")

    def field(name: str):
        return F.get("s", F.lit(loglines.SUMMARY_FIELDS.index(name)))

    owner = F.coalesce(field("owner"), F.get("n", F.lit(1)))
    name = F.coalesce(field("name"), F.get("n", F.lit(2)))
    rows = parsed.select(
        "line_no", F.concat_ws("/", owner, name).alias("repo"),
        *[F.coalesce(field(t).cast("bigint"), F.lit(0)).alias(t) for t in SNAPSHOT_TAGS],
    )
    return latest(rows, ["repo"], F.col("line_no"), SNAPSHOT_TAGS)


def missing_repos(old: DataFrame, new: DataFrame) -> DataFrame:
    """Repositories that only one of two snapshots has."""
    joined = old.select("repo", F.lit(True).alias("o")).join(new.select("repo", F.lit(True).alias("n")), "repo", "full_outer")
    only = joined.filter("o is null or n is null")
    return only.select("repo", F.when(F.col("o").isNull(), "OLD").otherwise("NEW").alias("missing_in"))


def snapshot_sizes(old: DataFrame, new: DataFrame) -> DataFrame:
    tagged = old.select(F.lit(1).alias("o"), F.lit(0).alias("n")).unionAll(new.select(F.lit(0), F.lit(1)))
    return tagged.agg(
        F.coalesce(F.sum("o"), F.lit(0)).cast("bigint").alias("old_size"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("new_size"),
    )


def compare(old: DataFrame, new: DataFrame) -> DataFrame:
    """Repositories of both snapshots with a changed count: old and new values and a message."""
    joined = old.alias("o").join(new.alias("n"), "repo")
    changed = {t: F.col(f"o.{t}") != F.col(f"n.{t}") for t in SNAPSHOT_TAGS}
    parts = [F.when(changed[t], F.format_string(t + " %d->%d", f"o.{t}", f"n.{t}")) for t in SNAPSHOT_TAGS]
    values = [F.col(f"{side}.{t}").alias(f"{name}_{t}") for t in SNAPSHOT_TAGS for side, name in (("o", "old"), ("n", "new"))]
    some = changed["n_success"] | changed["n_total"]
    return joined.filter(some).select("repo", *values, F.concat_ws(", ", *parts).alias("message"))


def decreases(compared: DataFrame) -> DataFrame:
    """One row per repository and count that went down."""
    pairs = F.array(*[
        F.struct(F.lit(t).alias("tag"), F.col(f"old_{t}").alias("old"), F.col(f"new_{t}").alias("new")) for t in SNAPSHOT_TAGS
    ])
    return compared.select("repo", F.inline(pairs)).filter("old > new")


def plain_values(log: DataFrame) -> DataFrame:
    parsed = loglines.plain_summaries(spread_where_few(log, "line_no"))
    return parsed.select("line_no", F.concat_ws("/", "owner", "name").alias("repo"), "ts", *SERIES_TAGS)


def series(log: DataFrame) -> DataFrame:
    """Time series of the counts of each repository in log order, one row per point."""
    return position_in_key(plain_values(log), ["repo"], "line_no", "pos")


def changed_repos(log: DataFrame) -> DataFrame:
    """Repositories whose counts are not all the same."""
    ranges = [F.expr(f"min({t}) <> max({t})") for t in SERIES_TAGS]
    grouped = plain_values(log).groupBy("repo").agg(
        *[r.alias(f"c{i}") for i, r in enumerate(ranges)]
    )
    return grouped.filter(" or ".join(f"c{i}" for i in range(len(ranges)))).select("repo")


def failing_repos(log: DataFrame) -> DataFrame:
    """Repositories whose latest record has fewer recorded Makefiles than Makefile directories."""
    last = latest(plain_values(log), ["repo"], F.col("line_no"), ["n_partial", "n_total"])
    return last.filter("n_partial < n_total")


def sample_failing(failing: DataFrame, count: int, seed: int) -> DataFrame:
    """A repeatable sample without replacement, then without repositories of too many Makefiles.

    With fewer repositories than asked for, all are taken.
    """
    ticket = F.md5(F.concat(F.lit(f"{seed}:"), F.col("repo")))
    return failing.orderBy(ticket, "repo").limit(count).filter(F.col("n_total") <= MAX_SAMPLED_MAKEFILES)


def makefile_report(dirs: DataFrame, recorded: DataFrame, keys: list[str]) -> DataFrame:
    """Each Makefile directory with an empty status when it was recorded, else ``Failed``."""
    known = recorded.select(*keys).distinct().withColumn("_recorded", F.lit(True))
    status = F.when(F.col("_recorded").isNull(), "Failed").otherwise("")
    return dirs.join(known, keys, "left").select(*keys, status.alias("status"))


def sampled_report(sampled: DataFrame, found: DataFrame, states: DataFrame) -> DataFrame:
    """Status of each Makefile directory of the sampled repositories: (repo, dir, status).

    ``found`` (repo, path) are the Makefile directories of the clones, below one folder of their own; ``states`` has the recorded Makefiles
    (repo_owner, repo_name, directory), below the four segments of the container. Both are re-rooted at owner and name, so that they meet.
    """
    chosen = sampled.select("repo").distinct()
    recorded = states.select(
        F.concat_ws("/", "repo_owner", "repo_name").alias("repo"),
        F.concat_ws("/", "repo_owner", "repo_name", F.nullif(names.drop_segments(F.col("directory"), 4), F.lit(""))).alias("dir"),
    )
    dirs = found.join(chosen, "repo", "left_semi").select("repo", names.drop_segments(F.col("path"), 1).alias("dir"))
    return makefile_report(dirs, recorded.join(chosen, "repo", "left_semi"), ["repo", "dir"])
