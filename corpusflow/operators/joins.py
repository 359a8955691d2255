"""Joins of repositories, binaries and files.

In each join one side is unique on the key (or reduced to its distinct keys), so the output never
exceeds the other side; adaptive execution splits a hot key of that side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.ordered import earliest, latest
from corpusflow.operators.state import REPO_KEY


def processed(match_func: DataFrame, force_reprocess: bool = False) -> DataFrame:
    """Repositories that need no further matching: all their matches have a tree."""
    done = match_func.filter("funcs_matched_without_ast = 0").select(*REPO_KEY)
    return done.filter(F.lit(False)) if force_reprocess else done


def unprocessed(repos: DataFrame, match_func: DataFrame, force_reprocess: bool = False) -> DataFrame:
    return repos.join(processed(match_func, force_reprocess), REPO_KEY, "left_anti")


def decompiled_for_repo(makefile_binary: DataFrame, binaries: DataFrame) -> DataFrame:
    """Binaries that were decompiled successfully for the repository that lists them."""
    return makefile_binary.join(binaries.filter("success").select(*REPO_KEY, "sha"), [*REPO_KEY, "sha"], "left_semi")


def first_claims(makefile_binary: DataFrame) -> DataFrame:
    """Within a repository a hash belongs to the first Makefile and path that list it."""
    order = F.struct("makefile_pos", "binary_pos")
    return earliest(makefile_binary, [*REPO_KEY, "sha"], order, ["makefile_pos", "binary_pos", "directory", "path"])


def work_items(makefile_binary: DataFrame, binaries: DataFrame) -> DataFrame:
    """Files to match: claimed once per repository; of a repeated directory only the last Makefile counts, and of a path
    that comes twice in a Makefile only the last hash."""
    claimed = first_claims(decompiled_for_repo(makefile_binary, binaries))
    last = claimed.groupBy(*REPO_KEY, "directory").agg(F.max("makefile_pos").alias("makefile_pos"))
    kept = claimed.join(last, [*REPO_KEY, "directory", "makefile_pos"], "left_semi")
    return latest(kept, [*REPO_KEY, "directory", "makefile_pos", "path"], F.col("binary_pos"), ["sha", "binary_pos"])


def present_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the other side has; its keys are made distinct before the shuffle."""
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def listed_products(produced: DataFrame, listed: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Produced files that are listed for their directory, with the hash recorded last by ``order``."""
    return produced.join(latest(listed, keys, order, ["sha"]), keys)


def keep_files(
    files: DataFrame, predicate: Callable[[Column, Column], Column], hash_of: Callable[[Column, Column], Column]
) -> DataFrame:
    """Files that a caller's predicate keeps, addressed by a caller's hash.

    Both take (directory, path) columns and give a column; a vectorised ``pandas_udf`` fits as well.
    """
    directory, path = F.col("directory"), F.col("path")
    return files.filter(predicate(directory, path)).withColumn("sha", hash_of(directory, path))
