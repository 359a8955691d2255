"""Token tables of source files and the functions found in them.

Files are moved once, as compact text, and exploded inside the partition of their key; every later window
and aggregate works on that key, so the much larger token rows are never shuffled. The unit of
work is one file, that is one input row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import ccode
from corpusflow.operators.ordered import last_values, latest, spread_by


def tokens(files: DataFrame, key: str, code: str = "code") -> DataFrame:
    """(key, piece, pos, value, type, line, col, offset) of all tokens; line and column count from one.

    ``piece`` also counts the spaces; it orders the tokens like ``pos``, and rows come sorted by it.
    """
    placed = spread_by(files.select(key, code), key)
    exploded = placed.select(key, F.posexplode(ccode.pieces(F.col(code))).alias("i", "value"))
    order = Window.partitionBy(key).orderBy("i")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    space = ccode.is_space(F.col("value"))
    newlines = F.length("value") - F.length(F.replace("value", F.lit("\n"), F.lit("")))
    zero = F.lit(0).cast("bigint")
    placed = exploded.select(
        key, "i", "value", space.alias("space"), newlines.cast("bigint").alias("newlines"),
        F.coalesce(F.sum(F.length("value")).over(before), zero).alias("offset"),
    )
    # Offset of the last newline inside a piece.
    tail = F.length(F.substring_index("value", "\n", -1))
    newline_at = F.when(F.col("newlines") > 0, F.col("offset") + F.length("value") - tail - 1)
    located = placed.select(
        key, "i", "value", "space", "offset",
        F.coalesce(F.sum(F.when(F.col("space"), 0).otherwise(1)).over(before), zero).alias("pos"),
        (F.coalesce(F.sum("newlines").over(before), zero) + 1).alias("line"),
        (F.col("offset") - F.coalesce(F.last(newline_at, ignorenulls=True).over(before), F.lit(-1))).alias("col"),
    )
    kept = located.filter("not space").withColumnRenamed("i", "piece")
    return kept.select(key, "piece", "pos", "value", ccode.token_type(F.col("value")).alias("type"), "line", "col", "offset")


def token_at(token_rows: DataFrame, probes: DataFrame, key: str, probe_id: str) -> DataFrame:
    """Position of the last token at or before each (line, col); null before the first token or for an invalid line."""
    places = token_rows.select(key, "line", "col", F.lit(0).alias("is_probe"), F.lit(None).cast("bigint").alias(probe_id), "pos")
    asked = probes.select(
        key, F.col("line").cast("bigint").alias("line"), F.col("col").cast("bigint").alias("col"), F.lit(1).alias("is_probe"),
        F.col(probe_id).cast("bigint").alias(probe_id), F.lit(None).cast("bigint").alias("pos"),
    )
    # probes of one file may be a large share of all, so files are not kept in one piece
    found = last_values(places.unionByName(asked).filter(F.col(key).isNotNull()), [key], ["line", "col", "is_probe"], "pos", "token_pos")
    valid = F.when(F.col("line") > 0, F.col("token_pos"))
    return found.filter("is_probe = 1").select(key, probe_id, "line", "col", valid.alias("token_pos"))


def matching_brace(token_rows: DataFrame, starts: DataFrame, key: str) -> DataFrame:
    """Position of the brace that closes the first one at or after each start; null when none does.

    The balance of braces is summed up once per file. An opening brace is closed by the next closing one after which the balance is what
    it was before the opening; both ends of a pair thus follow each other among the braces of the same depth.
    """
    change = F.when(F.col("value") == "{", 1).when(F.col("value") == "}", -1)
    order = Window.partitionBy(key).orderBy("pos")
    braces = token_rows.select(key, "pos", change.alias("change")).filter("change is not null")
    deep = braces.withColumn("depth", F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.greatest("change", F.lit(0)))
    after = F.lead(F.struct("pos", "change")).over(Window.partitionBy(key, "depth").orderBy("pos"))
    pairs = deep.select(key, "pos", "change", F.when(after["change"] == -1, after["pos"]).alias("close")).filter("change = 1")
    asked = starts.select(key, F.col("start").alias("pos"), F.lit(1).alias("asks"))
    placed = pairs.select(key, "pos", F.lit(0).alias("asks"), F.struct("close").alias("pair")).unionByName(
        asked.distinct(), allowMissingColumns=True
    )
    ahead = Window.partitionBy(key).orderBy(F.col("pos").desc(), "asks").rowsBetween(Window.unboundedPreceding, 0)
    found = placed.withColumn("pair", F.last("pair", ignorenulls=True).over(ahead)).filter("asks = 1")
    return found.select(key, F.col("pos").alias("start"), F.col("pair.close").alias("right"))


def spans(token_rows: DataFrame, key: str) -> DataFrame:
    """Tokens with the number of the top-level item they belong to and the brace depth before them.

    An item ends with a semicolon outside braces or with the brace that closes it.
    """
    order = Window.partitionBy(key).orderBy("piece")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    change = F.when(F.col("value") == "{", 1).when(F.col("value") == "}", -1).otherwise(0)
    zero = F.lit(0).cast("bigint")
    deep = token_rows.select(
        key, "piece", "pos", "value", "offset", F.coalesce(F.sum(change).over(before), zero).alias("depth"),
        F.lead("value").over(order).alias("after1"), F.lead("value", 2).over(order).alias("after2"), F.lag("value").over(order).alias("before1"),
    )
    ends = ((F.col("depth") <= 0) & (F.col("value") == ";")) | ((F.col("depth") == 1) & (F.col("value") == "}"))
    return deep.withColumn("item", F.coalesce(F.sum(F.when(ends, 1).otherwise(0)).over(before), zero))


def with_known_types(token_rows: DataFrame, key: str) -> DataFrame:
    """Add ``is_type``: the pseudo-types of the decompiler, and the names that a typedef of the file has given before.

    The name of a typedef is the word before its semicolon or array size, or the starred one in parentheses.
    """
    value = F.col("value")
    outside = F.col("depth") <= 0
    # a typedef goes on to the next semicolon outside braces, past those of a structure
    order = Window.partitionBy(key).orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)
    in_typedef = F.last(F.when(outside, F.when(value == "typedef", True).when(value == ";", False)), ignorenulls=True).over(order)
    ends = F.col("after1").isin(";", "[") | ((F.col("before1") == "*") & (F.col("after1") == ")") & (F.col("after2") == "("))
    named = token_rows.withColumn("_names", F.coalesce(in_typedef, F.lit(False)) & outside & ccode.is_identifier(value) & F.coalesce(ends, F.lit(False)))
    same = Window.partitionBy(key, "value").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    known = value.isin(ccode.PSEUDO_TYPES) | F.coalesce(F.max("_names").over(same), F.lit(False))
    return named.withColumn("is_type", known).drop("_names")


def top_level_items(files: DataFrame, key: str, code: str = "code") -> DataFrame:
    """Top-level items that hold a brace, with their tokens and the positions that describe them.

    ``left`` is the first token of the type; position zero counts as missing, then the declarator is
    taken. An item is part of one file, so its token list is bounded by an input row.
    """
    value, pos = F.col("value"), F.col("pos")
    outside = F.col("depth") == 0
    # a name stands before its parameters, by itself or in parentheses; a type that is known may stand before a parenthesis and is none
    in_parens = (F.col("before1") == "(") & (F.col("after1") == ")") & (F.col("after2") == "(")
    named = ccode.is_identifier(value) & ~value.isin(ccode.NOT_A_NAME) & ~F.col("is_type") & (
        ((F.col("after1") == "(") & (F.coalesce("after2", F.lit("")) != "*")) | F.coalesce(in_parens, F.lit(False))
    )
    typed = ~value.isin(ccode.SPECIFIERS)
    declared = ((value == "*") | named) & (pos > 0)
    items = with_known_types(spans(tokens(files, key, code), key), key).groupBy(key, "item").agg(
        F.sort_array(F.collect_list(F.struct("pos", "value")))["value"].alias("values"),
        F.min(pos).alias("first"), F.max(pos).alias("last"), F.min("offset").alias("begin_at"),
        (F.max("offset") + 1).alias("end_at"), F.min(F.when(outside & (value == "{"), pos)).alias("body"),
        F.min(F.when(outside & named, pos)).alias("name_pos"), F.min(F.when(outside & typed, pos)).alias("type_pos"),
        F.min(F.when(outside & declared, pos)).alias("declarator_pos"),
    )
    left = F.when(F.col("type_pos") > 0, F.col("type_pos")).otherwise(F.col("declarator_pos"))

    def token(at):
        return F.get("values", (at - F.col("first")).cast("int"))

    # Positions inside an item are consecutive, so a token is found by its distance from the first one.
    cut = F.slice("values", (left - F.col("first") + 1).cast("int"), (F.col("last") - left + 1).cast("int"))
    found = items.filter("body is not null").select(
        key, "item", "first", "last", "begin_at", "end_at", "body", left.alias("left"),
        F.when(F.col("body") > F.col("first"), token(F.col("body") - 1)).alias("before_body"),
        token(F.col("name_pos")).alias("func_name"), token(F.col("last")).alias("closing"),
        F.when(left.isNotNull(), cut).alias("tokens"),
    )
    return found.filter("closing = '}'")


def functions(items: DataFrame, key: str) -> DataFrame:
    """Function definitions: name, token range, body, text range and tokens; the last definition of a name counts."""
    defined = items.filter("before_body = ')' and func_name is not null and body > first")
    return latest(
        defined, [key, "func_name"], F.col("item"), ["first", "last", "body", "begin_at", "end_at", "left", "tokens"]
    )


def rejected_items(items: DataFrame, key: str) -> DataFrame:
    """Bodies without a parameter list before them at the top level: old-style definitions and macros."""
    kind = F.when(F.col("body") == F.col("first"), "body_only").when(F.col("func_name").isNull(), "no_name")
    return items.filter("body = first or (before_body = ')' and func_name is null)").select(
        key, "item", F.col("body").alias("body"), kind.alias("reason")
    )


def spliced(files: DataFrame, found: DataFrame, replacements: DataFrame, key: str) -> DataFrame:
    """File text with functions replaced by marked code; the rest of the text stays as it is."""
    pieces = found.join(replacements, [key, "func_name"]).select(
        key, F.struct("begin_at", "end_at", ccode.marked(F.col("func_name"), F.col("replacement")).alias("text")).alias("piece")
    )
    per_file = pieces.groupBy(key).agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    joined = files.join(per_file, key, "left")

    def assembled(text, parts):
        starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(parts, lambda p: p["end_at"]))
        kept = F.zip_with(
            parts, F.slice(starts, F.lit(1), F.size(parts)),
            lambda p, start: F.concat(text.substr((start + 1).cast("int"), (p["begin_at"] - start).cast("int")), p["text"]),
        )
        rest = text.substr((F.element_at(starts, -1) + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(kept, ""), rest)

    text = F.when(F.col("pieces").isNull(), F.col("code")).otherwise(assembled(F.col("code"), F.col("pieces")))
    return joined.select(key, text.alias("code"))
