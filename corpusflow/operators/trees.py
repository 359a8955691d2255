"""Syntax trees as node tables, for both tree formats: ``_t``/``_c``/``_p`` and node_id/children/x/y/z.

A tree is one input row, and its keys name it. Its text is cut at the brackets outside strings; running sums over the pieces give depths and depth-first numbers,
so a tree may be of any depth. Put together, the pieces that belong to one node are the JSON of the node with ``{}`` for each child, which the
JSON functions of Spark read and check. Values of attributes are scalars or lists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.ccode import bracket_pieces, unescaped
from corpusflow.functions.rows import with_once
from corpusflow.operators.ordered import spread_by

# Keys of the two formats.
TYPE_KEY, CHILDREN_KEY, POSITION_KEY = "_t", "_c", "_p"
CHILD_SLOTS = ["children", "x", "y", "z"]

_LAST_KEY = r'"([^"]*+)"\s*+:\s*+$'
_STRING = r'"[^"]*+"'


def _without(text: Column, key: str, value: str) -> Column:
    return F.regexp_replace(text, rf'"{key}"\s*+:\s*+{value}\s*+,?', "")


def _pieces(trees: DataFrame, keys: list[str], ast: str) -> DataFrame:
    """The pieces of each tree with what running sums tell of them; (keys, at, mark, rest, key, listed, owned ...)."""
    text = F.regexp_replace(F.col(ast), r"^\s+|\s+$", "")
    # the compact texts are moved once; everything below happens within the tree, on one sort after the other
    placed = spread_by(trees.select(*keys, ast), *keys)
    cut = with_once(placed.select(*keys, text.alias("_text")), _all=bracket_pieces(F.col("_text")))
    listed = F.coalesce(F.get("_all", F.lit(0)).rlike(rf'"(?:{TYPE_KEY}|{CHILDREN_KEY})"\s*+:'), F.lit(False))
    # the pieces make up the whole text, or it is no tree
    whole = F.when(unescaped(F.array_join("_all", "")) == F.col("_text"), F.col("_all"))
    cut = with_once(cut, _pieces=whole, _n=F.size("_all"), _listed=listed)
    rows = cut.select(*keys, "_n", "_listed", F.posexplode_outer("_pieces").alias("at", "piece"))
    mark = F.substring("piece", 1, 1)
    rows = rows.select(*keys, "_n", "at", "_listed", mark.alias("mark"), F.expr("substring(piece, 2)").alias("rest"))
    tree = Window.partitionBy(*keys).orderBy("at")
    upto = tree.rowsBetween(Window.unboundedPreceding, 0)
    opens, lists = F.when(F.col("mark").isin("{", "["), 1).otherwise(-1), F.when(F.col("mark") == "[", 1).when(F.col("mark") == "]", -1).otherwise(0)
    rows = rows.select(
        "*", F.regexp_extract(F.coalesce(F.lag("rest").over(tree), F.lit("")), _LAST_KEY, 1).alias("key"), F.lag("mark").over(tree).alias("before"),
        F.sum(opens).over(upto).alias("level"), F.sum(lists).over(upto).alias("lists"),
    )
    # between a node and its children lies one object of slots in the first format, none in the second
    step = F.when(F.col("_listed"), 2).otherwise(1)
    inside = (F.col("level") - F.col("lists")).cast("int")
    rows = rows.withColumn("depth", F.floor((inside - 1) / step).cast("int"))
    opens_slots = F.col("_listed") & (F.pmod(inside, F.lit(2)) == 0)  # what stands here is in the object of slots
    rows = rows.withColumn("in_slots", opens_slots)
    is_node = (F.col("mark") == "{") & ~F.col("in_slots")
    rows = rows.withColumn("is_node", is_node).withColumn("_seen", F.sum(F.col("is_node").cast("int")).over(upto))
    wrong = F.col("mark").isNull() | ((F.col("at") == 0) & (F.col("mark") != "{")) | ((F.col("at") < F.col("_n") - 1) != (F.col("level") > 0)) | (
        (F.col("mark") == "{") & F.col("in_slots") & (F.col("key") != CHILDREN_KEY)
    )
    # a node is the last one that was opened at its depth; its parent owns the piece before it
    at_depth = Window.partitionBy(*keys, "depth").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("wrong", wrong).withColumn("owner", F.max(F.when(F.col("is_node"), F.col("_seen") - 1)).over(at_depth))
    return rows.withColumn("parent", F.lag("owner").over(tree)).withColumn("list_key", F.lag("key").over(tree))


def _exploded(trees: DataFrame, keys: list[str], ast: str) -> DataFrame:
    """Node rows and ``bad``, which tells of any row whether its tree cannot be decoded."""
    rows = _pieces(trees, keys, ast)
    # a child ends with a brace that leads back to slots, or in the second format with any
    ends_child = (F.col("mark") == "}") & (~F.col("_listed") | F.col("in_slots"))
    own = F.when(F.col("is_node"), F.struct(
        "parent", "depth", "at", "_listed", F.when(F.col("before") == "[", F.col("list_key")).when(F.col("key") != "", F.col("key")).alias("named"),
        ((F.col("before") == "[") | (F.col("key") == "")).alias("in_list"),
    ))
    piece = F.struct(
        "at", F.concat(F.when(ends_child, "{}").otherwise(F.col("mark")), "rest").alias("shallow"),
        F.when(~F.col("in_slots"), F.concat(F.when(F.col("mark").isin("[", "]"), F.col("mark")).when(ends_child, "{}").otherwise(""), "rest")).otherwise("").alias("attrs"),
        F.when(F.col("in_slots"), F.col("rest")).otherwise("").alias("slots"),
    )
    nodes_ = rows.groupBy(*keys, "owner").agg(
        F.max(own).alias("own"), (F.max("_seen") - 1).cast("int").alias("last"), F.max("wrong").alias("wrong"), F.sort_array(F.collect_list(piece)).alias("pieces"),
    )
    joined = lambda name: F.array_join(F.col("pieces")[name], "")
    nodes_ = nodes_.select(*keys, F.col("owner").cast("int").alias("pre"), "last", "own.*", "wrong", joined("shallow").alias("shallow"), joined("attrs").alias("a"), joined("slots").alias("s"))
    listed = F.col("_listed")
    odd_slot = ~listed & ~F.coalesce(F.col("named").isin(CHILD_SLOTS), F.lit(True))
    no_json = F.col("pre").isNotNull() & F.try_parse_json(F.concat(unescaped(F.col("shallow")), F.lit("}"))).isNull()
    tree = Window.partitionBy(*keys)
    bad = F.max(F.coalesce(F.col("wrong") | odd_slot, F.lit(True)) | no_json).over(tree)
    # a name holds for the elements of a list up to the next name
    siblings = Window.partitionBy(*keys, "parent").orderBy("pre")
    upto = siblings.rowsBetween(Window.unboundedPreceding, 0)
    rows = nodes_.withColumn("bad", bad).withColumn("child_index", F.when(F.col("parent").isNotNull(), F.row_number().over(siblings) - 1))
    slot = F.last(F.when(F.col("named").isNotNull(), F.struct("named", "child_index")), ignorenulls=True).over(upto)
    following = F.lead("named").over(siblings)
    rows = rows.withColumn("_slot", slot).withColumn("_more", F.lead("in_list").over(siblings) & following.isNull())
    node_type = lambda key: F.regexp_extract("a", rf'"{key}"\s*+:\s*+"([^"]*+)"', 1)
    own_attrs = _without(_without(_without(F.col("a"), TYPE_KEY, _STRING), POSITION_KEY, r"(?:-?[0-9]+|null)"), CHILDREN_KEY, "")
    other_attrs = _without(_without(F.col("a"), "node_type", _STRING), f"(?:{'|'.join(CHILD_SLOTS)})", r"(?:\{\}|null|\[[{},\s]*+\])")
    attrs = F.regexp_replace(F.when(listed, own_attrs).otherwise(other_attrs), r"^\s+|\s*,?\s*$", "")
    nulls = lambda text, names: F.regexp_extract_all(text, F.lit(rf'"({names})"\s*+:\s*+null'), F.lit(1))
    return rows.select(
        *keys, "bad", "pre", "last", F.col("parent").cast("int").alias("parent"), "depth", unescaped(F.col("_slot.named")).alias("slot"),
        F.when(F.col("in_list") & F.col("parent").isNotNull(), F.col("child_index") - F.col("_slot.child_index")).cast("int").alias("ordinal"),
        F.when(F.col("in_list") & F.col("parent").isNotNull(), ~F.coalesce(F.col("_more"), F.lit(False))).alias("ends_list"), F.col("child_index").cast("int").alias("child_index"),
        F.nullif(unescaped(F.when(listed, node_type(TYPE_KEY)).otherwise(node_type("node_type"))), F.lit("")).alias("node_type"),
        F.when(listed, F.nullif(F.regexp_extract("a", rf'"{POSITION_KEY}"\s*+:\s*+(-?[0-9]+)', 1), F.lit(""))).cast("bigint").alias("token_pos"),
        unescaped(F.concat(F.lit("{"), attrs, F.lit("}"))).alias("attrs"),
        F.when(listed, nulls("s", '[^"]*+')).otherwise(nulls("a", "|".join(CHILD_SLOTS))).alias("null_slots"), "_listed",
    )


def nodes(trees: DataFrame, keys: list[str], ast: str) -> DataFrame:
    """One row per node of each tree; trees that are not valid JSON give none."""
    return _exploded(trees, keys, ast).filter("not bad and pre is not null").drop("bad")


def undecodable(trees: DataFrame, keys: list[str], ast: str) -> DataFrame:
    """Keys of the trees that are not valid JSON."""
    return _exploded(trees, keys, ast).filter("bad").select(*keys).distinct()


def with_paths(node_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add the path of each node from the root, made in one pass over the nodes of a tree; its text grows with the depth."""
    place = F.when(F.col("ordinal").isNotNull(), F.concat(F.lit("["), F.col("ordinal").cast("string"), F.lit("]"))).otherwise("")
    inner = F.when(F.col("_listed"), f".{CHILDREN_KEY}.").otherwise(".")
    step = F.struct("pre", "parent", F.concat(inner, F.coalesce("slot", F.lit("")), place).alias("step"))
    gathered = node_rows.groupBy(*keys).agg(F.sort_array(F.collect_list(step)).alias("steps"), F.collect_list(F.struct(*[c for c in node_rows.columns if c not in keys])).alias("rows"))
    path = lambda done, x: F.concat(done, F.array(F.when(x["parent"].isNull(), "$").otherwise(F.concat(F.get(done, x["parent"]), x["step"]))))
    paths = F.aggregate("steps", F.array().cast("array<string>"), path)
    out = gathered.select(*keys, paths.alias("paths"), "rows").select(*keys, "paths", F.inline("rows"))
    return out.withColumn("path", F.get("paths", F.col("pre"))).drop("paths")


#: How to fold two neighbouring results into one: over rows, for the type of the result, and of two values, either of which may be null.
KINDS = {
    "sum": (F.sum, lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def fold(node_rows: DataFrame, keys: list[str], results: dict[str, tuple[str | Callable[[Column, Column], Column], Column]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Fold each subtree in depth-first order: (keys, root, ``keep``, results by name).

    ``results`` gives how to fold and the value of a node: "sum", "min", "max", or any associative function of two values, such as
    structs, the first of which stands before the second in the tree. A subtree is a range of depth-first numbers. A tree, which is one input row,
    is gathered once; its values are folded to blocks of 1, 2, 4 ... numbers, and a range is made up of at most two blocks of each size,
    so the work grows with n log n, also on a tree that is one long chain.
    """
    values, how = [], {}
    for i, (kind, value) in enumerate(results.values()):
        if isinstance(kind, str):
            over, of_two = KINDS[kind]
            held = node_rows.agg(over(value)).schema[0].dataType
            value, how[f"_value{i}"] = value.cast(held), lambda a, b, f=of_two, t=held: f(a, b).cast(t)
        else:
            how[f"_value{i}"] = kind
        values.append(value.alias(f"_value{i}"))
    root = F.struct(F.col("pre").alias("root"), *keep)
    nodes_ = node_rows.select(*keys, F.struct("pre", F.col("last").alias("end"), root.alias("root"), F.struct(*values).alias("own")).alias("_node"))
    gathered = nodes_.groupBy(*keys).agg(F.sort_array(F.collect_list("_node")).alias("_nodes"))
    none = F.lit(None).cast(nodes_.schema["_node"].dataType["own"].dataType)

    def both(a: Column, b: Column) -> Column:
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.struct(*[f(a[v], b[v]).alias(v) for v, f in how.items()]))

    def folded(pieces: Column) -> Column:
        return F.aggregate(pieces, none, both)

    # a value for each number; where some have no node, or several, they are looked for
    n = (F.array_max(F.transform("_nodes", lambda x: F.greatest(x["pre"], x["end"]))) + 1).cast("int")
    dense = (F.size("_nodes") == n) & F.forall(F.sequence(F.lit(0), F.size("_nodes") - 1), lambda i: F.get("_nodes", i)["pre"] == i)
    at = lambda i: folded(F.transform(F.filter("_nodes", lambda x: x["pre"] == i), lambda x: x["own"]))
    single = F.when(dense, F.transform("_nodes", lambda x: x["own"])).otherwise(F.transform(F.sequence(F.lit(0), n - 1), at))
    trees_ = with_once(with_once(gathered, _single=single), _bits=F.length(F.bin(F.size("_single"))).cast("int") - 1)

    def doubled(levels: Column, _size: Column) -> Column:
        of = lambda i: F.get(F.element_at(levels, -1), i)
        pairs = F.floor(F.size(F.element_at(levels, -1)) / 2).cast("int")
        return F.concat(levels, F.array(F.transform(F.sequence(F.lit(0), pairs - 1), lambda i: both(of(2 * i), of(2 * i + 1)))))

    levels = F.aggregate(F.slice(F.sequence(F.lit(0), F.col("_bits")), F.lit(2), F.col("_bits")), F.array("_single"), doubled)
    trees_ = with_once(trees_, _levels=levels).drop("_single")
    sizes = F.sequence(F.lit(0), F.col("_bits"))

    def subtree(node: Column) -> Column:
        def blocks(first: bool) -> Column:
            def block(size: Column) -> Column:
                low = F.call_function("shiftright", node["pre"] + F.call_function("shiftleft", F.lit(1), size) - 1, size)
                high = F.call_function("shiftright", node["end"] + 1, size)
                number = low if first else high
                asked = (low < high) & (number.bitwiseAND(F.lit(1)) == 1)
                return F.when(asked, F.get(F.get("_levels", size), low if first else high - 1))

            return F.array_compact(F.transform(sizes, block))

        return folded(F.concat(blocks(True), F.reverse(blocks(False))))

    done = trees_.select(*keys, F.explode(F.transform("_nodes", lambda x: F.struct(x["root"].alias("root"), subtree(x).alias("own")))).alias("_done"))
    done = done.select(*keys, "_done.root.*", "_done.own.*")
    return done.select(*keys, "root", *keep, *[F.col(v).alias(n) for v, n in zip(how, results, strict=True)])


def rebased(node_rows: DataFrame, left: Column) -> DataFrame:
    """Token positions relative to the left boundary of the function; null stays null."""
    return node_rows.withColumn("token_pos", F.col("token_pos") - left)


def to_json(node_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Trees put together again from their nodes; positions are dropped.

    Each node gives an opening and a closing text; sorted in depth-first order they make up the JSON.
    """
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('":'))
    first_of_slot = F.col("slot").isNotNull() & F.coalesce(F.col("ordinal") == 0, F.lit(True))
    lead = F.concat(
        F.when(F.coalesce(F.col("child_index"), F.lit(0)) > 0, ",").otherwise(""),
        F.when(first_of_slot, quoted(F.col("slot"))).otherwise(""),
        F.when(F.col("ordinal") == 0, "[").otherwise(""),
    )
    attrs = F.when(F.col("attrs") == "{}", "").otherwise(F.concat(F.lit(","), F.expr("substring(attrs, 2, length(attrs) - 2)")))
    opening = F.concat(lead, F.lit('{"_t":"'), F.col("node_type"), F.lit('"'), attrs, F.lit(',"_c":{'))
    nulls = F.array_join(F.transform("null_slots", lambda s: F.concat(quoted(s), F.lit("null"))), ",")
    has_children = F.col("last") > F.col("pre")
    closing = F.concat(
        F.when(has_children & (F.size("null_slots") > 0), ",").otherwise(""), nulls, F.lit("}}"),
        F.when(F.col("ends_list"), "]").otherwise(""),
    )

    def event(at: Column, closes: int, inner: Column, text: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(closes).alias("closes"), inner.alias("inner"), text.alias("text"))

    events = node_rows.select(*keys, F.explode(F.array(
        event(F.col("pre"), 0, F.lit(0), opening), event(F.col("last"), 1, -F.col("depth"), closing)
    )).alias("e"))
    text = F.array_join(F.sort_array(F.collect_list("e"))["text"], "")
    return events.groupBy(*keys).agg(text.alias("ast"))


def renamed_parts(name: Column) -> tuple[Column, Column, Column]:
    """(variable id, old name, new name) of a marked identifier."""
    parts = F.split(name, "@@")
    return F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.get(parts, F.lit(3))
