"""Match run: preprocessed sources and decompiler output to matched functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import ccode
from corpusflow.functions.names import path_in_repo
from corpusflow.operators import matching, tokens
from corpusflow.operators.joins import present_in, work_items
from corpusflow.operators.rollups import match_summary
from corpusflow.operators.state import REPO_KEY
from corpusflow.session import settle


def distinct_sources(sources: DataFrame) -> DataFrame:
    """One text per hash, of several the first in order: copies are dropped before the expensive work."""
    return sources.groupBy("sha").agg(F.min("code").alias("code"))


def original_functions(sources: DataFrame) -> DataFrame:
    """(sha, func_name, original_tokens) of all functions defined in the sources, which are unique on the hash."""
    plain = sources.withColumn("code", ccode.without_line_controls(F.col("code")))
    found = tokens.functions(tokens.top_level_items(plain, "sha"), "sha")
    return found.select("sha", "func_name", F.col("tokens").alias("original_tokens"))


def decompiled_functions(lines: DataFrame, known: DataFrame, with_ast: bool = False) -> DataFrame:
    """(sha, func_name, variable_names, decompiled_tokens) of the functions that the sources define, and their tree as text if wanted."""
    wanted = matching.lines_of_known_functions(matching.named_lines(lines), known)
    rows, _undecodable = matching.decoded_lines(wanted, with_ast)
    good, _quarantined = matching.cleaned_functions(rows)
    tree = ["ast"] * with_ast
    last = matching.last_of_each(good, "line_pos", ["code", "variable_names", *tree])
    values = ccode.token_values(ccode.normalised(F.col("code")))
    return last.select(
        "sha", "func_name", "variable_names", values.alias("decompiled_tokens"), *[F.col(c).alias("decompiled_ast_json") for c in tree]
    )


def matched_functions(sources: DataFrame, lines: DataFrame) -> DataFrame:
    """Original functions with their decompiled counterparts.

    Sources without any output are dropped first; lines of other functions are dropped before decoding.
    The original functions are needed twice, so they are settled once.
    """
    with_output = present_in(distinct_sources(sources), lines, ["sha"])
    original = settle(original_functions(with_output))
    return matching.matched(original, decompiled_functions(lines, original))


def match_repositories(makefile_binary: DataFrame, binaries: DataFrame, sources: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(match records, summary per repository) of the whole run.

    Each repository's files are claimed once; a record has owner, name and path of its file, the tokens of both sides, the variable names
    and the tree of the decompiled side. There is no C parser, so the tree of the original side is null. The summary counts files and
    functions and is what updates the match state.
    """
    items = settle(work_items(makefile_binary, binaries).select(*REPO_KEY, "sha", path_in_repo(
        F.col("repo_owner"), F.col("repo_name"), F.col("directory"), F.col("path")
    ).alias("file_path")))
    found = settle(present_in(distinct_sources(present_in(sources, items, ["sha"])), lines, ["sha"]))
    original = settle(original_functions(found))
    decompiled = settle(decompiled_functions(lines, original, with_ast=True))
    matched = items.join(matching.matched(original, decompiled), "sha")
    rows = matching.records(matched.withColumn("original_ast_json", F.lit(None).cast("string")))
    files = items.join(found.select("sha", F.lit(True).alias("found")), "sha", "left").withColumn("found", F.coalesce("found", F.lit(False)))
    sides = original.select("sha", "func_name").join(
        decompiled.select("sha", "func_name", F.lit(True).alias("matched"), F.col("decompiled_ast_json").isNotNull().alias("has_ast")),
        ["sha", "func_name"], "left",
    ).na.fill(False, ["matched", "has_ast"])
    return rows, match_summary(files, items.select(*REPO_KEY, "sha").join(sides, "sha"), REPO_KEY)
