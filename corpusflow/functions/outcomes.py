"""Outcome classification from exit states and captured output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Messages of the version-control client and of make.
NOT_FOUND_MESSAGES = [
    "fatal: could not read Username for 'https://github.com': terminal prompts disabled",
    "remote: Repository not found.",
]
MISSING_SEPARATOR = "missing separator"
OUT_OF_PROCESSES = "Resource temporarily unavailable"


def contains_any(text: Column, messages: list[str]) -> Column:
    found = F.lit(False)
    for message in messages:
        found = found | F.contains(text, F.lit(message))
    return F.coalesce(found, F.lit(False))


def clone_outcome(
    folder_exists: Column, exited_ok: Column, timed_out: Column, output: Column, submodule_failed: Column
) -> tuple[Column, Column]:
    """(success, error) of a clone; failed submodules leave it a success with an error."""
    error = (
        F.when(folder_exists, "FolderExists")
        .when(timed_out, "Timeout")
        .when(exited_ok & submodule_failed, "SubmodulesFailed")
        .when(exited_ok, F.lit(None))
        .when(contains_any(output, NOT_FOUND_MESSAGES), "PrivateOrNonexistent")
        .otherwise("Unknown")
    )
    success = F.coalesce(~folder_exists & ~timed_out & exited_ok, F.lit(False))
    return success, error


def make_outcome(timed_out: Column, return_code: Column, os_error: Column, output: Column) -> tuple[Column, Column]:
    """(error, retry with BSD make) of one make run; a null error is a success."""
    failed = return_code != 0
    error = F.when(timed_out, "Timeout").when(os_error, "Unknown").when(failed, "CompileFailed")
    retry = ~timed_out & ~os_error & failed & F.contains(output, F.lit(MISSING_SEPARATOR))
    return error, F.coalesce(retry, F.lit(False))


def batch_suppressed(elapsed: Column, limit: Column, output: Column) -> Column:
    """Whether a failed batch is passed over: it ran too long or out of processes; else it is fatal."""
    late = F.coalesce(elapsed > limit, F.lit(False))
    return late | F.coalesce(F.contains(output, F.lit(OUT_OF_PROCESSES)), F.lit(False))


def decompile_outcome(already_present: Column, timed_out: Column, variables: Column, failed: Column) -> Column:
    return (
        F.when(already_present, "Success")
        .when(timed_out, "TimedOut")
        .when(F.coalesce(variables, F.lit(0)) == 0, "NoVariables")
        .when(failed, "UnknownError")
        .otherwise("Success")
    )


def match_status(has_error: Column, matches: Column) -> Column:
    some = matches > 0
    return F.when(~has_error & some, "success").when(~has_error | some, "warning").otherwise("error")


def work_plan(
    known: Column, cloned: Column, compiled: Column, archived: Column, folder: Column,
    force_reclone: bool = False, force_recompile: bool = False,
) -> tuple[Column, Column]:
    """(source of the repository, needs compiling); tested in this order, a null state is an unknown repository."""
    reclone, recompile = F.lit(force_reclone), F.lit(force_recompile)
    cloned, compiled = F.coalesce(cloned, F.lit(False)), F.coalesce(compiled, F.lit(False))
    todo = ~compiled | recompile
    source = (
        F.when(known & cloned & ~reclone & ~todo, "skip")
        .when(~reclone & archived, "extract")
        .when(~known | reclone | (cloned & todo & ~folder), "clone")
        .when(~cloned, "dummy")
        .otherwise("reuse")
    )
    needs = ~source.isin("skip", "dummy") & (~known | todo)
    return source, needs


def recorded(success: Column, binaries: Column) -> Column:
    """Whether the result of a Makefile is kept."""
    return success | (binaries > 0)


def within_size(size: Column, limit: int | None) -> Column:
    return F.lit(True) if limit is None else size <= F.lit(limit)


def eligible(cloned: Column, compiled: Column, makefiles: Column, binaries: Column) -> Column:
    """Whether there is anything to match in a repository."""
    return cloned & compiled & (makefiles != 0) & (binaries != 0)
