"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.session import settle, working_path

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_SPACE_BYTES = b" \t\n\x0b\x0c\r"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class Brief:
    """A table written to the shared folder, to be deleted as soon as what is made of it is written."""

    table: DataFrame
    path: str

    def delete(self) -> None:
        spark = self.table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def brief(df: DataFrame, options: dict | None = None) -> Brief:
    """As ``settle``, for a table that is deleted by its maker; ``options`` are those of Parquet."""
    path = working_path(df.sparkSession, "brief")
    df.write.options(**options or {}).parquet(path)
    return Brief(df.sparkSession.read.schema(df.schema).parquet(path), path)


@contextmanager
def thrifty(spark: SparkSession, also: dict[str, str] | None = None) -> Iterator[None]:
    """Queries inside leave no shuffle files behind when they end; ``also`` are further settings for them."""
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", **(also or {})}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, also where the body uses it in nested functions."""
    return F.transform(F.array(value), body)[0]


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """Whole rows as one column ``_row`` beside the given columns, so that no name of theirs can clash with an operator's own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[c.alias(n) for n, c in columns.items()])


def unpacked(names: list[str]) -> list[Column]:
    """The columns of the rows that ``packed`` put away."""
    return [F.col("_row").getField(n).alias(n) for n in names]


def encoded(text: str | None) -> bytes:
    """UTF-8 bytes of a text; unpaired surrogates, which Arrow never delivers, would be replaced."""
    return (text or "").encode("utf-8", "replace")


def lowered(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased; other letters stay."""
    return encoded(text).translate(_LOWER)


def running_sums(df: DataFrame, keys: list[str], order: list[str | Column], sums: dict[str, Column]) -> DataFrame:
    """Add for each name the sum over the earlier rows of the same keys, in the given order.

    Rows are dealt by ranges of (keys, order) and written once; sums run inside each range, and the totals of earlier
    ranges, one row per key and range, are added. A key with a third of the rows thus spreads over many ranges. Rows that
    are equal in keys and order come in any order. Keys may be null.
    """
    flags = {f"_k{i}": F.col(k).isNull() for i, k in enumerate(keys)}
    values = {f"_v{i}": c for i, c in enumerate(sums.values())}
    ranks = {f"_o{i}": (F.col(c) if isinstance(c, str) else c) for i, c in enumerate(order)}
    ranged = df.withColumns(flags | values | ranks).repartitionByRange(*flags, *keys, *ranks)
    ranged = settle(ranged.withColumn("_part", F.spark_partition_id()))
    totals = ranged.groupBy(*flags, *keys, "_part").agg(*[F.sum(v).alias(v) for v in values])
    before = Window.partitionBy(*flags, *keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *[F.col(k).alias(f"_c{k}") for k in [*flags, *keys]], F.col("_part").alias("_c_part"),
        *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_carry{v}") for v in values],
    )
    inside = Window.partitionBy(*flags, *keys, "_part").orderBy(*ranks).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns({f"_in{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    same = F.col("_part") == F.col("_c_part")
    for k in [*flags, *keys]:
        same = same & F.col(k).eqNullSafe(F.col(f"_c{k}"))
    out = local.join(carry, same)
    added = [(F.col(f"_in{v}") + F.col(f"_carry{v}")).alias(n) for n, v in zip(sums, values, strict=True)]
    return out.select(*df.columns, *added)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def texts_of(column: pa.Array, size: int = 256) -> Iterator[str | None]:
    """The texts of a column one after the other; only a slice of them is held as Python strings."""
    for begin in range(0, len(column), size):
        yield from column.slice(begin, size).to_pylist()


def map_texts(df: DataFrame, keep: list[str], text: str, each: Callable[[str | None], tuple], fields: dict[str, str]) -> DataFrame:
    """The columns ``keep`` as they are and the ``fields`` (name: type) that ``each`` makes of one text, batch by batch."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [each(t) for t in texts_of(batch.column(text))]
            made = [pa.array(list(v), type=_ARROW[t]) for v, t in zip(zip(*rows, strict=True), fields.values(), strict=True)] if rows else [
                pa.array([], type=_ARROW[t]) for t in fields.values()
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], *made], [*keep, *fields])
        pa.default_memory_pool().release_unused()

    kinds = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep] + [f"`{n}` {t}" for n, t in fields.items()]
    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(mapped, ", ".join(kinds))


def map_parts(df: DataFrame, text: str, gather: Callable[[Iterator[str | None]], Iterator[dict[str, list]]], fields: dict[str, str]) -> DataFrame:
    """Rows that ``gather`` makes of all texts of a partition, such as sums; it yields columns by name."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (t for batch in batches for t in texts_of(batch.column(text)))
        for columns in gather(texts):
            yield pa.RecordBatch.from_arrays([pa.array(columns[n], type=_ARROW[t]) for n, t in fields.items()], list(fields))
        pa.default_memory_pool().release_unused()

    return df.select(text).mapInArrow(mapped, ", ".join(f"`{n}` {t}" for n, t in fields.items()))
