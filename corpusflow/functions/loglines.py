"""Parsing of build-run log lines: one regular-expression pass per line and pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.rows import with_present

# The log formats. Order of the groups: see the fields.
STAMP = r"([0-9-]{10} [0-9:]{8}),\d{3} \w+: "
WORKER = r"\(Worker \s*\d+\) "
COUNTS = r"(\d+) \((\d+)\) out of (\d+) Makefile\(s\) in "
YIELD = r" compiled \(partially\), yielding (\d+) binaries"
SUMMARY = STAMP + WORKER + COUNTS + r"(\S+?)/(\S+?)" + YIELD
SUMMARY_PLAIN = STAMP + COUNTS + r"(\w+)/(\w+)" + YIELD
NO_MAKEFILES = STAMP + WORKER + r"No Makefiles found in (\S+?)/(\S+?), repository deleted"
SUMMARY_FIELDS = ["ts", "n_success", "n_partial", "n_total", "owner", "name", "n_binaries"]
NO_MAKEFILES_FIELDS = ["ts", "owner", "name"]

_MARK = "\n"  # no line holds it


def groups(line: Column, pattern: str, count: int) -> Column:
    """All groups of the first match as an array; null when the line does not match."""
    around = "(?s)^.*?" + pattern + ".*$"
    joined = F.regexp_replace(line, around, _MARK.join(["", *[f"${i + 1}" for i in range(count)]]))
    parts = F.split(joined, _MARK)
    whole = F.filter(F.array(parts), lambda p: F.size(p) == count + 1)  # one evaluation of the parts
    return F.slice(F.get(whole, F.lit(0)), 2, count)


def _parse(log: DataFrame, pattern: str, fields: list[str]) -> DataFrame:
    found = with_present(log.select("line_no", "line"), "g", groups(F.col("line"), pattern, len(fields)))
    columns = [
        F.get("g", F.lit(i)).cast("bigint" if f.startswith("n_") else "string").alias(f) for i, f in enumerate(fields)
    ]
    return found.select("line_no", *columns)


def summaries(log: DataFrame) -> DataFrame:
    """Summary lines written by workers."""
    return _parse(log, SUMMARY, SUMMARY_FIELDS)


def plain_summaries(log: DataFrame) -> DataFrame:
    """Summary lines without a worker tag; names of word characters only."""
    return _parse(log, SUMMARY_PLAIN, SUMMARY_FIELDS)


def without_makefiles(log: DataFrame) -> DataFrame:
    return _parse(log, NO_MAKEFILES, NO_MAKEFILES_FIELDS)
