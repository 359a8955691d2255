"""Variable uses and control graphs of decompiled functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.ordered import position_in_key
from corpusflow.session import settle

# Names made up by the decompiler, the sentinel of ambiguous address sets, finished renames.
AUTO_NAME = r"^(v|a)[0-9]+$"
AMBIGUOUS = "::NONE::"
RENAMED = r"^@@VAR_[0-9]+"

VARIABLE = ["binary_id", "func_id", "name"]
PAGE = 1 << 16  # addresses per partial set


def _sets(rows: DataFrame, visit: str | None = None) -> DataFrame:
    """Address set per variable; ``visit`` also gives its earliest visit. Without addresses the key is null.

    The uses, which are narrow, are dealt by variable once; sets and digests, which are wide, are made where they lie and not moved.
    """
    first = [] if visit is None else [F.min(visit).alias("first_visit")]
    used = [*VARIABLE, "ea", *[visit for _ in first]]
    pages = rows.select(*used).repartition(*VARIABLE).groupBy(*VARIABLE, F.floor(F.col("ea") / PAGE).alias("page")).agg(
        F.sort_array(F.collect_set("ea")).alias("addresses"), *first
    )
    digests = pages.select(
        *VARIABLE, *["first_visit" for _ in first], F.size("addresses").cast("bigint").alias("n"),
        F.when(F.col("page").isNotNull(), F.struct("page", F.sha2(F.array_join("addresses", ","), 256).alias("digest"))).alias("part"),
    )
    parts = F.sort_array(F.collect_list("part"))
    key = F.when(F.size(parts) > 0, F.sha2(F.array_join(parts["digest"], ","), 256))
    again = [F.min("first_visit").alias("first_visit") for _ in first]
    return digests.groupBy(*VARIABLE).agg(F.sum("n").alias("n_addresses"), key.alias("addr_key"), *again)


def address_sets(uses: DataFrame) -> DataFrame:
    """Address set of each variable that the decompiler did not name itself, as its size and an order-free digest.

    Sets are collected per page of addresses, so that a list never exceeds a page, and the digests of
    the pages make the digest of the set. Equal digests are equal sets, as with content hashes.
    """
    return _sets(uses.filter("ea is not null").filter(~F.col("name").rlike(AUTO_NAME)))


def address_names(uses: DataFrame) -> DataFrame:
    """Address set to name per binary; a set that occurs twice is ambiguous for good, also under one name."""
    grouped = address_sets(uses).groupBy("binary_id", "addr_key").agg(F.count("*").alias("n"), F.min("name").alias("name"))
    return grouped.select(
        "binary_id", "addr_key", F.when(F.col("n") > 1, AMBIGUOUS).otherwise(F.col("name")).alias("new_name")
    )


def rename_variables(uses: DataFrame, names: DataFrame) -> DataFrame:
    """New name of each variable by its address set, else its own; ``first_visit`` is its earliest use."""
    sets = _sets(uses.filter(~F.col("name").rlike(RENAMED)), visit="visit")
    usable = names.filter(F.col("new_name") != AMBIGUOUS)
    found = sets.join(usable, ["binary_id", "addr_key"], "left")
    return found.select(*VARIABLE, "first_visit", F.coalesce("new_name", "name").alias("new_name"))


def assign_variable_ids(renamed: DataFrame) -> DataFrame:
    """Dense ids per binary in the order of first visits, and the marked name of each variable."""
    numbered = position_in_key(renamed, ["binary_id"], "first_visit", "var_id")
    marked = F.format_string("@@VAR_%d@@%s@@%s", "var_id", "name", "new_name")
    return numbered.withColumn("marked", marked)


def single_parents(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Parent of each node that has exactly one predecessor."""
    grouped = edges.groupBy(*keys, "dst").agg(F.count("*").alias("n"), F.min("src").alias("parent_id"))
    return grouped.filter("n = 1").select(*keys, F.col("dst").alias("node_id"), "parent_id")


def nearest_addresses(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Address of the nearest ancestor that has one: (keys, node_id, pred_ea), null when there is none.

    ``nodes`` has node_id, parent_id (null unless there is one predecessor) and ea. Each round doubles the distance a
    pointer spans, so a chain of depth d takes log2(d) rounds. Nodes that only lead into a cycle without an address have none: after
    log2(nodes) + 1 rounds every pointer that is still open runs in a cycle.
    """
    own = nodes.select(*keys, F.col("node_id").alias("ptr"), F.col("ea").alias("pred_ea"))
    state = nodes.select(*keys, "node_id", F.col("parent_id").alias("ptr")).join(own, [*keys, "ptr"], "left")
    state = settle(state.select(*keys, "node_id", "ptr", "pred_ea"))
    open_rows = "pred_ea is null and ptr is not null"
    for _ in range(state.count().bit_length() + 1):
        if not state.filter(open_rows).take(1):
            break
        done = state.filter(f"not ({open_rows})")
        target = state.select(
            *keys, F.col("node_id").alias("ptr"), F.col("ptr").alias("next_ptr"), F.col("pred_ea").alias("next_ea")
        )
        moved = state.filter(open_rows).drop("pred_ea").join(target, [*keys, "ptr"], "left")
        moved = moved.select(*keys, "node_id", F.col("next_ptr").alias("ptr"), F.col("next_ea").alias("pred_ea"))
        state = settle(done.unionByName(moved))
    return state.select(*keys, "node_id", "pred_ea")


def nearest_in_graph(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Nearest address up a control graph of nodes (node_id, ea) and edges (src, dst).

    The walk goes on as long as a node has exactly one predecessor: it ends where paths join, at an entry, and on a cycle without an address.
    """
    parents = single_parents(edges, keys)
    return nearest_addresses(nodes.select(*keys, "node_id", "ea").join(parents, [*keys, "node_id"], "left"), keys)


def with_inherited_addresses(uses: DataFrame, nearest: DataFrame, keys: list[str]) -> DataFrame:
    """Uses without an address take the nearest one above them; those without any are dropped."""
    joined = uses.join(nearest, [*keys, "node_id"], "left")
    return joined.withColumn("ea", F.coalesce("ea", "pred_ea")).drop("pred_ea").filter("ea is not null")


def degrees(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Number of successors and predecessors of each node."""
    ends = edges.select(*keys, F.col("src").alias("node_id"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(
        edges.select(*keys, F.col("dst").alias("node_id"), F.lit(0).alias("o"), F.lit(1).alias("i"))
    )
    counts = ends.groupBy(*keys, "node_id").agg(F.sum("o").alias("nsucc"), F.sum("i").alias("npred"))
    return nodes.select(*keys, "node_id").join(counts, [*keys, "node_id"], "left").na.fill(0, ["nsucc", "npred"])


def adjacency(edges: DataFrame, keys: list[str], near: str, far: str, chunk: int = 1024) -> DataFrame:
    """Neighbour lists in pieces: one list holds the neighbours of one range of ``chunk`` node numbers."""
    piece = F.floor(F.col(far) / chunk).alias("piece")
    grouped = edges.groupBy(*keys, F.col(near).alias("node_id"), piece).agg(F.sort_array(F.collect_set(far)).alias("neighbours"))
    return grouped
