"""Decompiled functions cleaned and matched with the original functions of the same binary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import ccode
from corpusflow.functions.rows import with_once
from corpusflow.operators.ordered import latest, spread_where_few

#: Most words of 64 bits in a filter of keys: 16 MB.
FILTER_WORDS = 1 << 21


def named_lines(lines: DataFrame) -> DataFrame:
    """Raw lines with the function name peeked from the text; null names are data errors."""
    return lines.withColumn("func_name", ccode.function_name(F.col("line")))


def _bits(keys: list[str], size: int) -> list[Column]:
    """The two bits that stand for a key in a filter of ``size`` words of 64 bits, as (word, bit)."""
    hashes = [F.xxhash64(F.lit(seed), *keys) for seed in (0, 1)]
    return [
        F.struct(F.pmod(F.shiftright(h, 6), F.lit(size)).cast("int").alias("word"), h.bitwiseAND(F.lit(63)).cast("int").alias("bit")) for h in hashes
    ]


def possibly_known(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows but most of those whose keys ``known`` does not hold, without a shuffle of the rows.

    The keys mark two bits each in a filter of sixteen bits a key and at most ``FILTER_WORDS`` words, one row that goes to all tasks. No row with a known
    key is lost; ``known`` is read twice.
    """
    size = 1 << max(6, min(FILTER_WORDS.bit_length() - 1, (known.count() // 4).bit_length()))
    one = F.lit(1).cast("bigint")
    marks = known.select(F.explode(F.array(*_bits(keys, size))).alias("m")).select("m.word", F.call_function("shiftleft", one, F.col("m.bit")).alias("bits"))
    empty = rows.sparkSession.range(size).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = marks.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    held = words.agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("_filter"))  # one row
    first, second = [F.getbit(F.get("_filter", b["word"]), b["bit"]) == 1 for b in _bits(keys, size)]
    return rows.join(F.broadcast(held), first & second).drop("_filter")


def lines_of_known_functions(lines: DataFrame, known: DataFrame, spread: int = 8) -> DataFrame:
    """Lines whose function the original file defines, found before any JSON is decoded.

    Most other lines go before the shuffle. Lines are salted and the table of known names is repeated per salt, so a function that fills
    much of the input does not end up in one task; it is also reduced before its next shuffle. The repeated table grows with the
    sources and its size is not known before it is made, so it is never sent whole to the tasks. ``known`` is read three times and should be settled.
    """
    keys = ["sha", "func_name", "_salt"]
    near = possibly_known(lines, known, keys[:2])
    salted = near.withColumn("_salt", F.pmod(F.xxhash64("line_pos"), F.lit(spread)).cast("int"))
    repeated = known.select("sha", "func_name", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_salt"))
    return salted.join(repeated.hint("merge"), keys, "left_semi").drop("_salt")


def decoded_lines(lines: DataFrame, with_ast: bool = True) -> tuple[DataFrame, DataFrame]:
    """(decoded rows, rejected lines). The tree stays JSON text, of any depth, and is left out if it is not wanted."""
    parsed = spread_where_few(lines, "line").select("*", F.inline(F.array(ccode.decoded(F.col("line")))))
    kept = [c for c in lines.columns if c != "line"]
    good = parsed.filter("_corrupt is null and raw_code is not null")
    bad = parsed.filter("_corrupt is not null or raw_code is null")
    return good.select(*kept, "raw_code", *[ccode.tree_of(F.col("line")).alias("ast")] * with_ast), bad.select(*kept, "line")


def variable_rows(rows: DataFrame) -> DataFrame:
    """One row per variable of each function; functions in which one id has different names are left out."""
    found = with_once(spread_where_few(rows, "raw_code"), triples=ccode.variables(F.col("raw_code"))).filter(~ccode.conflicting(F.col("triples")))
    return found.select(*[c for c in rows.columns if c != "raw_code"], F.inline("triples"))


def full_names(rows: DataFrame) -> DataFrame:
    """Code of each function with its whole name."""
    code = ccode.with_full_name(F.col("raw_code"), F.col("func_name")).alias("code")
    return spread_where_few(rows, "raw_code").select(*[c for c in rows.columns if c != "raw_code"], code)


def cleaned_functions(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cleaned functions, quarantined ones). A function is put aside when one variable id has
    different names."""
    raw = F.col("raw_code")
    prepared = with_once(rows, triples=ccode.variables(raw), prefix=ccode.safe_prefix(raw))
    reason = F.when(ccode.conflicting(F.col("triples")), "conflicting_names")
    checked = prepared.withColumn("reason", reason)
    code = ccode.cleaned(raw, F.col("prefix"), F.col("func_name"))
    names = F.map_from_entries(
        F.transform("triples", lambda t: F.struct(
            F.concat(F.col("prefix"), F.lit("_"), t["id"]), F.struct(t["decompiled"].alias("decompiled"), t["original"].alias("original"))
        ))
    )
    good = checked.filter("reason is null").withColumn("code", code).withColumn("variable_names", names)
    return good.drop("triples", "reason", "raw_code"), checked.filter("reason is not null").drop("triples", "prefix")


def last_of_each(rows: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """A function that occurs again in a file replaces the earlier one."""
    return latest(rows, ["sha", "func_name"], F.col(order), columns)


def matched(original: DataFrame, decompiled: DataFrame) -> DataFrame:
    """Original and decompiled functions of the same hash and name; both sides are unique on them."""
    return original.join(decompiled, ["sha", "func_name"])


def records(rows: DataFrame) -> DataFrame:
    """Matched functions as JSON records."""
    fields = [
        "file_path", F.col("sha").alias("binary_hash"), "func_name", "variable_names", "original_tokens", "decompiled_tokens",
        "original_ast_json", "decompiled_ast_json",
    ]
    return rows.select("repo_owner", "repo_name", "sha", "func_name", F.to_json(F.struct(*fields)).alias("record"))
