"""Build run: repository list to planned work, results to recorded Makefiles and state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import names, outcomes
from corpusflow.operators import state as states
from corpusflow.operators.ordered import position_in_key, running_total
from corpusflow.operators.state import REPO_KEY


def named_repos(repo_list: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repositories with owner and name, rejected lines) of a repository list."""
    line = F.col("line")
    named = repo_list.withColumn("repo_owner", names.repo_owner(line)).withColumn("repo_name", names.repo_name(line))
    return named.filter("repo_owner is not null").drop("line"), named.filter("repo_owner is null").select("idx", "line")


def requests(repo_list: DataFrame, state: DataFrame) -> DataFrame:
    """Repository list with the known state of each entry; duplicates in the list stay."""
    named, _rejected = named_repos(repo_list)
    known = state.withColumn("known", F.lit(True))
    return named.join(known, REPO_KEY, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def plan_work(
    repo_list: DataFrame, state: DataFrame, archived: Column, folder: Column,
    force_reclone: bool = False, force_recompile: bool = False,
) -> DataFrame:
    """What to do with each listed repository."""
    source, needs = outcomes.work_plan(
        F.col("known"), F.col("clone_successful"), F.col("compiled"), archived, folder, force_reclone, force_recompile
    )
    return requests(repo_list, state).withColumn("source", source).withColumn("needs_compile", needs)


def first_repos(repo_list: DataFrame, count: int) -> DataFrame:
    """The first ``count`` listed repositories."""
    return named_repos(repo_list)[0].orderBy("idx").limit(count)


def first_pending(eligible: DataFrame, order: str, count: int) -> DataFrame:
    """The first ``count`` repositories that are really emitted, numbered in order."""
    return position_in_key(eligible.orderBy(order).limit(count), [], order, "index")


def apply_results(state: DataFrame, results: DataFrame) -> DataFrame:
    """New repository state after a batch of results.

    Makefiles are kept as rows elsewhere; a result carries their counts, null when the stage did not run.
    """
    decided = states.repo_updates(results, state)
    added = states.add_repos(
        state,
        decided.filter("add_repo").select(*REPO_KEY, "seq", "clone_successful", F.col("stored_size").alias("repo_size")),
    )
    counted = decided.filter("has_makefiles").select(*REPO_KEY, "seq", "num_makefiles", "num_binaries")
    return states.update_makefile_counts(added, counted)


def within_budget(runs: DataFrame, keys: list[str], budget: int | None) -> DataFrame:
    """Makefiles that run: the time of the earlier ones is below the budget; no budget means no limit.

    ``runs`` has ``elapsed`` and a whole number ``pos``, unique within the keys.
    """
    if budget is None:
        return runs
    used = running_total(runs, keys, "pos", F.col("elapsed"), "_used")
    return used.filter(F.col("_used") < budget).drop("_used")


def recorded_makefiles(made: DataFrame) -> DataFrame:
    """Makefiles that succeeded or yielded binaries."""
    return made.filter(outcomes.recorded(F.col("success"), F.col("n_binaries")))
