"""Decompile run: pending binaries, outcome of attempts, and the names recovered for variables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import outcomes
from corpusflow.operators import graph, rollups


def binary_actions(mapping: DataFrame, state: DataFrame) -> DataFrame:
    """Per hash: ``process`` (not in the state), ``skip`` (known owner) or ``migrate`` (legacy entry)."""
    known = state.select("sha", F.col("repo_owner").alias("_owner"), F.lit(True).alias("_known"))
    action = F.when(F.col("_known").isNull(), "process").when(F.col("_owner").isNull(), "migrate").otherwise("skip")
    return mapping.join(known, "sha", "left").withColumn("action", action).drop("_owner", "_known")


def pending(makefile_binary: DataFrame, state: DataFrame) -> DataFrame:
    """Binaries still to be decompiled: deduplicated over all repositories, then those not in the state."""
    return rollups.binary_mapping(makefile_binary).join(state.select("sha"), "sha", "left_anti")


def classify_attempts(attempts: DataFrame, present: DataFrame) -> DataFrame:
    """Status of each attempt; output that is already there counts as a success."""
    there = present.select("sha").distinct().withColumn("_there", F.lit(True))
    status = outcomes.decompile_outcome(
        F.col("_there").isNotNull(), F.coalesce("timed_out", F.lit(True)), F.col("variables"), F.coalesce("failed", F.lit(False))
    )
    return attempts.join(there, "sha", "left").withColumn("status", status).drop("_there")


def recovered_names(original_uses: DataFrame, stripped_uses: DataFrame) -> DataFrame:
    """Rename variables of the stripped binary by the uses collected from the original one."""
    return graph.assign_variable_ids(graph.rename_variables(stripped_uses, graph.address_names(original_uses)))
