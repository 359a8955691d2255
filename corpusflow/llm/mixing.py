"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order. A copy of a document finishes at the virtual time
(words of its source up to and including it) / (target of its source); copies of all sources are range-sorted by that time
and taken until the total budget is reached. A source that must give more than it has is run through again, so that a
document is taken up to ``max_repeats`` times.

Defined results: a null text has no words; a null source is a source of its own, last in order; rows that repeat (doc_id, source,
size) queue one behind the other, each by itself; documents without words are taken for nothing; an empty table gives an empty table.
Only doc_id, source and text are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import WORD, packed, running_sums, unpacked
from corpusflow.session import settle

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: (source, source_size, target).

    Sources in order of code points, null last, weigh ``weights`` in turn and share the total. A target stops at
    ``max_repeats`` times the size of its source; what is over is shared again by weight, until no target is above its limit.
    Sources are sorted by limit per weight: those at their limit then come first, and one pass of running sums finds them.
    """
    sizes = settle(units.groupBy("source").agg(F.sum("size").alias("source_size")))
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    ranked = running_sums(sizes, [], [F.col("source").isNull(), "source"], {"rank": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    ranked = settle(ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * max_repeats))
    all_weights = ranked.agg(F.sum("weight")).first()[0] or 0
    filled = running_sums(
        ranked, [], [(F.col("most") / F.col("weight")).alias("level"), "rank"], {"used": F.col("most"), "gone": F.col("weight")}
    )
    share = (F.lit(total) - F.col("used")) / (F.lit(all_weights) - F.col("gone"))
    filled = settle(filled.withColumn("full", F.col("most") / F.col("weight") <= share))
    used, left = filled.agg(
        F.sum(F.when(F.col("full"), F.col("most"))), F.sum(F.when(~F.col("full"), F.col("weight")))
    ).first()
    rest = (F.col("weight") * F.lit(total - (used or 0))).cast("double") / F.lit(float(left or 1))
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(rest)
    return filled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of each row of ``docs``; ``copies`` is how often it is taken."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    # rows that are equal are told apart by their place in the table that is written here, and only there
    units = settle(sized.withColumn("tie", F.monotonically_increasing_id()))
    goals = source_targets(units, weights, max_repeats)
    total = goals.agg(F.sum("source_size")).first()[0] or 0
    goals = goals.withColumnRenamed("source", "_source")
    placed = units.join(goals, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    shuffled = placed.withColumn("mark", F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 16))
    amount = F.col("size")
    queued = settle(running_sums(shuffled, ["source"], ["mark", "doc_id", "size", "tie"], {"begin": amount}))

    passes = F.sequence(F.lit(0), F.lit(max_repeats - 1))
    start = lambda p: p.cast("long") * F.col("source_size") + F.col("begin")

    def wanted(p: Column) -> Column:
        # Copies that start before time 1 fill the budget, so no later one can be taken.
        return (start(p) < F.col("target")) & (F.col("size") > 0)

    def place(p: Column) -> Column:
        finish = (start(p) + amount).cast("double") / F.col("target")
        return F.struct(
            finish.alias("finish"), F.col("source").isNull().alias("last"), F.col("source").alias("source"), p.alias("round"),
            F.col("begin").alias("begin"),
        )

    copies = queued.select(amount.alias("amount"), F.explode(F.filter(passes, wanted)).alias("p"), "*")
    copies = copies.select("amount", place(F.col("p")).alias("place"))
    ranged = copies.repartitionByRange("place").withColumn("part", F.spark_partition_id())
    edge = _first_beyond(settle(ranged), total)
    taken = wanted if edge is None else (lambda p: wanted(p) & (place(p) < _literal(edge, copies)))
    return queued.select(
        "doc_id", "source", "size", "source_size", "target", F.size(F.filter(passes, taken)).alias("copies")
    )


def _first_beyond(ranged: DataFrame, budget: int):
    """Place of the first copy with which the total goes over the budget; None if there is none."""
    parts = running_sums(
        ranged.groupBy("part").agg(F.sum("amount").alias("amount")), [], ["part"], {"before": F.col("amount")}
    )  # one row per range
    over = parts.filter(F.col("before") + F.col("amount") > budget).orderBy("part").select("part", "before").first()
    if over is None:
        return None
    inside = running_sums(
        ranged.filter(F.col("part") == over["part"]), [], ["place"], {"before": F.col("amount")}
    )
    beyond = inside.filter(F.col("before") + F.col("amount") > budget - over["before"])
    return beyond.agg(F.min("place")).first()[0]


def _literal(place, copies: DataFrame) -> Column:
    fields = copies.schema["place"].dataType.fields
    return F.struct(*[F.lit(place[f.name]).cast(f.dataType).alias(f.name) for f in fields])


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The documents that the mix takes, with all their columns and ``copies``; documents taken zero times are left out."""
    taken = mix(docs, weights, max_repeats).filter("copies > 0").groupBy("doc_id", "source", "size").agg(
        *[F.count_if(F.col("copies") > p).alias(f"_taken{p}") for p in range(max_repeats)]
    )
    decided = settle(taken.select(
        F.col("doc_id").alias("_doc_id"), F.col("source").alias("_source"), F.col("size").alias("_size"),
        F.array(*[f"_taken{p}" for p in range(max_repeats)]).alias("_taken"),
    ))
    rows = packed(docs, id=F.col("doc_id"), from_=F.col("source"), words=word_count(F.col("text")))
    same = F.col("id").eqNullSafe(F.col("_doc_id")) & F.col("from_").eqNullSafe(F.col("_source")) & (F.col("words") == F.col("_size"))
    columns = [c for c in docs.columns if c != "copies"]
    # Decisions are small and unique on the key: they are hashed, and the texts are not sorted.
    met = rows.join(decided.hint("shuffle_hash"), same)
    many = F.element_at("_taken", 1) > 1
    copies = lambda at: F.size(F.filter("_taken", lambda k: k > at)).alias("copies")
    out = met.filter(~many).select(*unpacked(columns), copies(F.lit(0)))
    if decided.filter(many).isEmpty():
        return out
    # of rows that share id, source and size, the first so many are taken in each pass, in the order of their texts
    order = [F.xxhash64("_row.text"), F.monotonically_increasing_id()]
    shared = running_sums(met.filter(many), ["id", "from_", "words"], order, {"_at": F.lit(1).cast("long")})
    return out.unionByName(shared.filter(F.col("_at") < F.element_at("_taken", 1)).select(*unpacked(columns), copies(F.col("_at"))))
