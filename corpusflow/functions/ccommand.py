"""Compiler and pkg-config command lines.

A command is first rewritten so that every flag holds its own value; after that each question is one regular
expression over the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.rows import with_once
from corpusflow.operators.ordered import spread_where_few

# Flags that are dropped, flags dropped with their value, and flags that are appended.
DROPPED = ["-c", "-Wall", "-Werror", "-Wextra", "-flto", "-mlittle-endian", "-mapcs", "-mno-sched-prolog"]
DROPPED_WITH_VALUE = ["-mabi", "-march", "-mtune"]
DROPPED_PREFIXES = ["-o", "-l", "-O", "-ggdb"]
APPENDED = ["-O0", "-g"]

_END = r"(?=\s|$)"
_DROP = (
    r"\s(?:" + "|".join(DROPPED) + ")" + _END
    + r"|\s(?:" + "|".join(DROPPED_WITH_VALUE) + r")(?:=\S*)?" + _END
    + r"|\s(?:" + "|".join(DROPPED_PREFIXES) + r")\S*"
)


def arguments(command: Column) -> Column:
    """The command without its program, each argument after a space and each flag joined to its value."""
    text = F.regexp_replace(F.trim(command), r"^\S+", "")
    text = F.regexp_replace(text, r"(?<=\s)(-[olO])\s+(?=[^\s-])", "$1")
    return F.regexp_replace(text, r"(?<=\s)(-m(?:abi|arch|tune))\s+(?=[^\s-])", "$1=")


def _values(args: Column, flag: str) -> Column:
    return F.regexp_extract_all(args, F.lit(rf"\s{flag}(\S+)"), F.lit(1))


def libraries(command: Column) -> Column:
    return _values(arguments(command), "-l")


def parsed(commands: DataFrame, command: str = "cmd", override_flags: str = "") -> DataFrame:
    """Libraries, source files, object file and effective argument list of each compiler call."""
    staged = with_once(spread_where_few(commands, command), _args=arguments(F.col(command)))
    kept = F.ltrim(F.regexp_replace(F.regexp_replace("_args", _DROP, ""), r"\s+", " "))
    staged = with_once(
        staged, libs=_values(F.col("_args"), "-l"), _kept=kept, _objects=_values(F.col("_args"), "-o"),
        _compile=F.col("_args").rlike(r"\s-c" + _END),
    )
    staged = with_once(staged, sources=F.regexp_extract_all("_kept", F.lit(r"(?:^|\s)(\S+\.[ch])" + _END), F.lit(1)))
    last_c = F.try_element_at(F.filter("sources", lambda s: F.endswith(s, F.lit(".c"))), F.lit(-1))
    derived = F.when(F.col("_compile"), F.regexp_replace(last_c, r"\.c$", ".o"))
    staged = with_once(staged, object=F.coalesce(F.try_element_at("_objects", F.lit(-1)), derived, F.lit("a.out")))
    effective = F.concat_ws(
        " ", F.lit("gcc"), F.when(F.col("_compile"), "-c"), F.nullif(F.col("_kept"), F.lit("")), F.lit("-o"), F.col("object"),
        F.lit(" ".join([*APPENDED, *override_flags.split()])), F.transform("libs", lambda lib: F.concat(F.lit("-l"), lib)),
    )
    return staged.withColumn("effective", effective).drop("_args", "_kept", "_objects", "_compile")


def failed_libraries(commands: DataFrame, keys: list[str], command: str = "cmd") -> DataFrame:
    """Libraries named by compiler calls that failed, one row per mention."""
    failed = spread_where_few(commands.filter("rc <> 0"), *keys)
    return failed.select(*keys, F.explode(libraries(F.col(command))).alias("library"))


def failed_packages(commands: DataFrame, keys: list[str], command: str = "cmd") -> DataFrame:
    """Arguments without a dash of pkg-config calls that failed."""
    text = F.regexp_replace(F.trim(F.col(command)), r"^\S+", "")
    named = F.regexp_extract_all(text, F.lit(r"\s([^\s-]\S*)"), F.lit(1))
    return commands.filter("rc <> 0").select(*keys, F.explode(named).alias("library"))
