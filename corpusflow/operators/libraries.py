"""Library names resolved to packages of a catalogue.

Five name patterns of a library are tried in order of priority; inside a pattern the package with the
fewest characters outside the match wins, then the smallest name. Testing every pattern on
every package would be a cross join. Instead each package offers its substrings, and a library
finds them by equality. In a library name ``_`` stands for ``-`` or ``_`` and ``.`` for any character, so a
name always matches text of its own length: with dashes folded into underscores, the name or its longest part
between dots is looked up by equality, and what it finds is checked against the exact rule. All other characters
of a name stand for themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.ordered import spread_by

# The endings after a library name in the patterns.
VERSION = r"(?:-?[0-9.]+)?"
DEV = "-dev"
MAX_NEW_INSTALLS = 50
#: Up to so many names, the texts asked for are sent to all tasks; beyond it every text of a package is summed up before the join.
BROADCAST_NAMES = 1_000_000


def _fold(text: Column) -> Column:
    return F.translate(text, "-", "_")


def _blot(text: Column, mask: Column) -> Column:
    """Text with a dot wherever the mask has one."""
    at = F.instr(mask, ".")
    one = F.concat(text.substr(F.lit(1), at - 1), F.lit("."), text.substr(at + 1, F.length(text)))
    chars = F.zip_with(F.split(text, ""), F.split(mask, ""), lambda c, m: F.when(m == ".", ".").otherwise(c))
    single = F.length(mask) - F.length(F.replace(mask, F.lit("."), F.lit(""))) == 1
    return F.when(single, one).otherwise(F.array_join(chars, ""))


def _holds(lib: Column, part: Column) -> Column:
    """Whether each dash of the library name is a dash in the text; only folded names need the check."""
    same = F.zip_with(F.split(lib, ""), F.split(part, ""), lambda c, p: (c != "-") | (p == "-"))
    return ~(F.contains(lib, F.lit("-")) & F.contains(part, F.lit("_"))) | F.forall(same, lambda x: x)


def _substrings(packages: DataFrame) -> DataFrame:
    """All substrings of each package name with their folded text."""
    length = F.length("pkg")
    ends = packages.select("pkg", F.explode(F.sequence(F.lit(1), length)).alias("end"))
    parts = ends.select("pkg", "end", F.explode(F.sequence(F.lit(1), F.col("end"))).alias("start"))
    return parts.select("pkg", "start", "end", _fold(F.expr("substring(pkg, start, end - start + 1)")).alias("key"))


def _longest_run(lib: Column) -> Column:
    """The longest part of a name between dots, as (size, -place, run, letters before it)."""
    runs = F.split(lib, r"\.")
    sized = F.transform(runs, lambda r, i: F.struct(F.length(r).alias("size"), (-i).alias("place"), r.alias("run")))
    best = F.array_max(sized)
    before = F.aggregate(
        F.slice(runs, 1, -best["place"]), F.lit(0), lambda n, r: n + F.length(r) + 1
    )
    return F.struct(best["run"].alias("run"), before.alias("before"))


def _found(wanted: DataFrame, parts: DataFrame) -> DataFrame:
    """Places (lib, pkg, start, end) of packages that a library name matches.

    A name without dots equals the folded text there. Of a name with dots the longest run of letters is looked up, and the text around it
    is compared.
    """
    has_dot = F.contains("lib", F.lit("."))
    plain = wanted.filter(~has_dot).withColumn("key", _fold(F.col("lib")))
    direct = parts.join(plain, "key").select("lib", "pkg", "start", "end")

    dotted = wanted.filter(has_dot).select("lib", F.length("lib").alias("len"), _longest_run(F.col("lib")).alias("r"))
    runs = dotted.filter("r.run <> ''").select("lib", "len", _fold(F.col("r.run")).alias("key"), F.col("r.before").alias("before"))
    around = parts.join(runs, "key").select("lib", "pkg", (F.col("start") - F.col("before")).alias("start"), "len")
    around = around.filter("start > 0 and start + len - 1 <= length(pkg)")
    around = around.select("lib", "pkg", "start", (F.col("start") + F.col("len") - 1).alias("end"))
    mask = F.regexp_replace("lib", r"[^.]", "x")
    around = around.filter(_blot(_fold(F.expr("substring(pkg, start, end - start + 1)")), mask) == _fold(F.col("lib")))

    found = direct.unionByName(around)
    return found.filter(_holds(F.col("lib"), F.expr("substring(pkg, start, end - start + 1)")))


def _hits(found: DataFrame, by: list[str]) -> DataFrame:
    """(by, pkg, priority, size) of each pattern that holds around a place, the leftmost of each package."""
    rest = F.expr("substring(pkg, end + 1)")
    found = found.select(
        *by, "pkg", "start", (F.col("end") - F.col("start") + 1).alias("len"), F.startswith(rest, F.lit(DEV)).alias("dev"),
        F.length(F.regexp_extract(rest, "^" + VERSION + DEV, 0)).alias("tail_dev"),
        F.length(F.regexp_extract(rest, "^" + VERSION, 0)).alias("tail"),
        F.expr("start > 3 and substring(pkg, start - 3, 3) = 'lib'").alias("lib_before"),
    )
    before, name = F.col("lib_before"), F.col("len")

    def pattern(priority: int, holds: Column, prefix: int, tail: Column) -> Column:
        hit = F.struct(
            F.lit(priority).alias("priority"), (F.col("start") - prefix).alias("at"), (name + prefix + tail).alias("size")
        )
        return F.when(holds, hit)

    patterns = F.array_compact(F.array(
        pattern(1, before & F.col("dev"), 3, F.lit(len(DEV))),
        pattern(2, before & (F.col("tail_dev") > 0), 3, F.col("tail_dev")),
        pattern(3, before, 3, F.col("tail")),
        pattern(4, F.col("tail_dev") > 0, 0, F.col("tail_dev")),
        pattern(5, F.lit(True), 0, F.lit(0)),
    ))
    return found.select(*by, "pkg", F.inline(patterns)).groupBy(*by, "priority", "pkg").agg(F.min_by("size", "at").alias("size"))


def _best(hits: DataFrame, by: list[str]) -> DataFrame:
    """The package of each pattern with the least text outside of it."""
    outside = F.length("pkg") - F.col("size")
    return hits.groupBy(*by, "priority").agg(F.min(F.struct(outside.alias("outside"), F.col("pkg").alias("pkg"))).alias("b"))


def candidates(libs: DataFrame, packages: DataFrame) -> DataFrame:
    """Best package per library and pattern: (lib, priority, outside, pkg).

    A name without dots asks for a text, folded or, with dashes, as it is; a name of dots alone asks for a length. For each text or length
    asked for, only the best package of each pattern is kept, inside the partitions of the packages first, and libraries are joined
    to these. So a name of one letter costs one row for each task, however many packages have the letter. Other names with dots, and
    names with both dashes and underscores, are compared place by place.
    """
    lib = F.col("lib")
    has = lambda c: F.contains(lib, F.lit(c))
    wanted = libs.select("lib").distinct().select(
        "lib", F.when(lib.rlike(r"^\.+$"), "length").when(has("."), None).when(~has("-"), "folded").when(~has("_"), "text").alias("kind"),
    ).withColumn("value", F.when(F.col("kind") == "length", F.length("lib").cast("string")).when(F.col("kind") == "folded", _fold(lib)).otherwise(lib))
    indexed = wanted.filter("kind is not null")
    parts = _substrings(spread_by(packages.select("pkg").distinct(), "pkg"))
    text = F.expr("substring(pkg, start, end - start + 1)")
    ways = F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), v.alias("value"))
        for k, v in (("folded", F.col("key")), ("text", text), ("length", (F.col("end") - F.col("start") + 1).cast("string")))
    ])).alias("way")
    keyed = parts.select("pkg", "start", "end", ways).select("pkg", "start", "end", "way.*")
    asked = indexed.select("kind", "value").distinct()
    if asked.count() <= BROADCAST_NAMES:
        keyed = keyed.join(F.broadcast(asked), ["kind", "value"], "left_semi")
    by = ["kind", "value"]
    best = indexed.join(_best(_hits(keyed, by), by), by).select("lib", "priority", "b")
    compared = wanted.filter("kind is null").select("lib")
    if not compared.isEmpty():
        best = best.unionByName(_best(_hits(_found(compared, parts), ["lib"]), ["lib"]))
    return best.select("lib", "priority", "b.outside", "b.pkg")


def best_packages(libs: DataFrame, packages: DataFrame, installs: DataFrame | None = None) -> DataFrame:
    """The package of each library by the first pattern that has one.

    ``installs`` (pkg, new_installs) drops a pattern's package when it would pull in too many others.
    """
    ranked = candidates(libs, packages)
    if installs is not None:
        counts = installs.groupBy("pkg").agg(F.max("new_installs").alias("new_installs"))
        ranked = ranked.join(counts, "pkg", "left").filter(F.coalesce("new_installs", F.lit(0)) <= MAX_NEW_INSTALLS)
    first = ranked.groupBy("lib").agg(F.min(F.struct("priority", "outside", "pkg")).alias("b"))
    return first.select("lib", "b.priority", "b.outside", "b.pkg")
