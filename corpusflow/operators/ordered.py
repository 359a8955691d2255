"""Ordered computations that hold when one key owns a large share of the rows.

A window over such a key would put the key into one task. Here the rows are dealt by ranges of key and order and
written once: a window runs inside each range, range totals are summed up over the small table of ranges, and the two are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.session import settle

#: Types of fixed width, whose values a hash aggregate can replace in place.
FIXED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType)
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def spread_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows spread by keys over twice the configured number of partitions, before they are exploded.

    The number is given, as adaptive execution would size partitions by the compact rows, of which the
    exploded ones are a large multiple.
    """
    return df.repartition(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def spread_where_few(df: DataFrame, *keys: str) -> DataFrame:
    """Rows spread by keys over the configured number of partitions if the source lists fewer files than tasks can run at once, else as they are.

    For operators that run costly patterns on each row: a table of one file would keep a single task busy. The listing decides, never
    the rows, and no file is opened for it.
    """
    spark = df.sparkSession
    if not 0 < len(df.inputFiles()) < spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)


def running_totals(
    df: DataFrame, keys: list[str], order: str, sums: dict[str, Column], inclusive: bool = False, parts: int | None = None
) -> DataFrame:
    """Add for each name the running sum within ``keys`` by ``order``, which is unique within the keys.

    The input is read once. Ranges hold about the same number of rows whatever the values of ``order``, so a hot key is spread
    over many; ``parts`` sets their number.
    """
    values = {f"_value{i}": c for i, c in enumerate(sums.values())}
    valued = df.withColumns(values)
    ranged = valued.repartitionByRange(parts, *keys, order) if parts else valued.repartitionByRange(*keys, order)
    ranged = settle(ranged.withColumn("_part", F.spark_partition_id()))
    totals = ranged.groupBy(*keys, "_part").agg(*[F.sum(v).alias(v) for v in values])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_part").alias("_key_part"),
        *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_carry{v}") for v in values],
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = ranged.withColumns({f"_local{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    same = F.col("_part") == F.col("_key_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    added = [(F.col(f"_local{v}") + F.col(f"_carry{v}")).alias(n) for n, v in zip(sums, values, strict=True)]
    return local.join(carry, same).select(*df.columns, *added)


def last_values(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Add the last value that is not null at or before each row of the same keys, in the given order.

    Rows are dealt by ranges of keys and order as for running sums; of each range and key the last value is carried on to the later ranges.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(df.repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()))
    ends = ranged.filter(F.col(value).isNotNull()).groupBy(*keys, "_part").agg(F.max_by(value, F.struct(*order)).alias("_end"))
    present = ranged.select(*keys, "_part").distinct().join(ends, [*keys, "_part"], "left")  # keys are never null here
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = present.select(*keys, "_part", F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_local", F.last(value, ignorenulls=True).over(inside))
    return local.join(carry, [*keys, "_part"]).select(*df.columns, F.coalesce("_local", "_carry").alias(name))


def running_total(
    df: DataFrame, keys: list[str], order: str, value: Column, name: str, inclusive: bool = False, parts: int | None = None
) -> DataFrame:
    """Running sum of ``value`` within ``keys`` by ``order``."""
    return running_totals(df, keys, order, {name: value}, inclusive, parts)


def position_in_key(df: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """Zero-based position of each row within its key, by a column unique in the key."""
    return running_total(df, keys, order, F.lit(1).cast("bigint"), name)


def global_index(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    """Dense zero-based index over the whole table, sorted by a unique key of any type.

    The table is range-partitioned and settled once; the index is the row number inside its
    range plus the size of the earlier ranges.
    """
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    placed = settle(ranged.withColumn("_row", F.monotonically_increasing_id()))
    placed = placed.withColumn("_range", F.shiftright("_row", _ROW_BITS))
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_size"))
    # One row per range: as many rows as the sort had partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    index = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + F.col("_offset")
    return placed.join(F.broadcast(offsets), "_range").withColumn(name, index).drop("_row", "_range", "_offset")


def latest(df: DataFrame, keys: list[str], order: Column, columns: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, reduced before the shuffle.

    Columns of fixed width are picked one by one, all by the same row: these are reduced in a hash table, without a sort of the rows.
    """
    if all(isinstance(f.dataType, FIXED) for f in df.select(order, *columns).schema):
        return df.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in columns])
    picked = F.max_by(F.struct(*columns), order).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns])


def earliest(df: DataFrame, keys: list[str], order: Column, columns: list[str]) -> DataFrame:
    """The row with the smallest ``order`` per key, reduced before the shuffle."""
    picked = F.min_by(F.struct(*columns), order).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns])


def from_key_on(df: DataFrame, matches: Column, order: str, inclusive: bool) -> DataFrame:
    """Rows from the first match of the condition on; without a match there are no rows."""
    first = df.agg(F.min(F.when(matches, F.col(order))).alias("_first"))  # one row
    wanted = F.col(order) >= F.col("_first") if inclusive else F.col(order) > F.col("_first")
    return df.join(F.broadcast(first), wanted).drop("_first")


def batches(df: DataFrame, order_by: list[str], size: int) -> DataFrame:
    """Number the rows by a unique key and assign them to batches of ``size``; no row comes twice."""
    indexed = global_index(df.dropDuplicates(order_by), order_by, "idx")
    return indexed.withColumn("batch", F.floor(F.col("idx") / F.lit(size)))


def progress(df: DataFrame, order: str, every: int, sums: dict[str, Column]) -> DataFrame:
    """Running totals after each ``every`` completed results; ``order`` is dense and starts at zero.

    The rows are reduced to one per block first; the running sum then works on the blocks.
    """
    block = F.floor(F.col(order) / F.lit(every)).alias("block")
    totals = df.groupBy(block).agg(
        F.count("*").alias("results"), *[F.sum(c).cast("bigint").alias(n) for n, c in sums.items()]
    )
    names = ["results", *sums]
    done = running_totals(totals, [], "block", {f"_{n}": F.col(n) for n in names}, inclusive=True)
    return done.select("block", *[F.col(f"_{n}").alias(n) for n in names])
