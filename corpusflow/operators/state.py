"""State tables: upserts, constraints and keyed lookup.

A state is a DataFrame with one row per key. An upsert reduces the updates of a batch to the
last one per key before the shuffle, joins the old state once and gives the new state; plain files have no
merge, so the caller writes it as a new snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.ordered import earliest, latest

REPO_KEY = ["repo_owner", "repo_name"]
MATCH_COUNTERS = ["files_found", "funcs_found", "funcs_matched", "funcs_matched_without_ast"]


def _merge(state: DataFrame, updates: DataFrame, keys: list[str], columns: list[Column]) -> DataFrame:
    return state.alias("s").join(updates.alias("u"), keys, "full_outer").select(*keys, *columns)


def add_repos(state: DataFrame, updates: DataFrame, seq: str = "seq") -> DataFrame:
    """Insert repositories with defaults, or set only ``clone_successful`` and ``repo_size`` of known ones."""
    new = latest(updates, REPO_KEY, F.col(seq), ["clone_successful", "repo_size"])
    new = new.withColumn("_new", F.lit(True))
    columns = [
        F.when(F.col("_new"), F.coalesce(F.col("u.repo_size"), F.lit(-1))).otherwise(F.col("s.repo_size")).alias("repo_size"),
        F.when(F.col("_new"), F.col("u.clone_successful")).otherwise(F.col("s.clone_successful")).alias("clone_successful"),
        F.coalesce("s.compiled", F.lit(False)).alias("compiled"),
        F.coalesce("s.num_makefiles", F.lit(0)).cast("bigint").alias("num_makefiles"),
        F.coalesce("s.num_binaries", F.lit(0)).cast("bigint").alias("num_binaries"),
    ]
    if "makefiles" in state.columns:
        empty = F.array().cast(state.schema["makefiles"].dataType)
        columns.append(F.coalesce("s.makefiles", empty).alias("makefiles"))
    return _merge(state, new, REPO_KEY, columns)


def binaries_in(makefiles: Column) -> Column:
    """Number of binaries in a nested list of Makefiles."""
    sizes = F.transform(makefiles, lambda m: F.size(m["binaries"]).cast("bigint"))
    return F.aggregate(sizes, F.lit(0).cast("bigint"), lambda total, size: total + size)


def storable(makefiles: Column) -> Column:
    """Whether all strings of the nested list are valid text."""
    return F.forall(
        makefiles,
        lambda m: F.is_valid_utf8(m["directory"])
        & F.forall(m["binaries"], F.is_valid_utf8)
        & F.forall(m["sha256"], F.is_valid_utf8),
    )


def update_makefiles(
    state: DataFrame, updates: DataFrame, seq: str = "seq", ignore_length_mismatch: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(new state, report). Sets ``compiled``, the nested Makefiles and the counts derived from them; ``stored`` is the length of the new list.

    The report has one row per updated repository: ``stored``, ``not_encodable`` (counts kept, list
    left empty), or the rejects ``unknown_repo`` and ``length_mismatch``.
    """
    # What is told of a list is told before it is moved, in columns of their own: a reader of counts or of the report moves no list.
    told = updates.select(*REPO_KEY, seq, "makefiles", F.size("makefiles").alias("_length"), storable(F.col("makefiles")).alias("_storable"), binaries_in(F.col("makefiles")).alias("_binaries"))
    picked = [F.max_by(c, seq).alias(c) for c in ("makefiles", "_length", "_storable", "_binaries")]
    new = told.groupBy(*REPO_KEY).agg(*picked).withColumn("_new", F.lit(True))
    joined = state.withColumn("_old_length", F.size("makefiles")).alias("s").join(new.alias("u"), REPO_KEY, "full_outer")
    old_length, new_length = F.col("s._old_length"), F.col("u._length")
    known = F.col("s.compiled").isNotNull()
    mismatch = F.lit(not ignore_length_mismatch) & (old_length != 0) & (old_length != new_length)
    outcome = (
        F.when(~known, "unknown_repo")
        .when(mismatch, "length_mismatch")
        .when(~F.col("u._storable"), "not_encodable")
        .otherwise("stored")
    )
    marked = joined.select(
        *REPO_KEY, known.alias("_known"), F.when(F.col("_new"), outcome).alias("outcome"),
        F.col("s.repo_size").alias("repo_size"), F.col("s.clone_successful").alias("clone_successful"),
        F.col("s.compiled").alias("_compiled"), F.col("s.num_makefiles").alias("_m"), F.col("s.num_binaries").alias("_b"),
        F.col("s.makefiles").alias("_old"), F.col("u.makefiles").alias("_list"), old_length.alias("_old_length"), new_length.alias("_length"), F.col("u._binaries").alias("_binaries"),
    )
    written = F.col("outcome").isin("stored", "not_encodable")
    empty = F.array().cast(state.schema["makefiles"].dataType)
    new_state = marked.filter("_known").select(
        *REPO_KEY, "repo_size", "clone_successful",
        F.when(written, True).otherwise(F.col("_compiled")).alias("compiled"),
        F.when(written, F.col("_length").cast("bigint")).otherwise(F.col("_m")).alias("num_makefiles"),
        F.when(written, F.col("_binaries")).otherwise(F.col("_b")).alias("num_binaries"),
        F.when(F.col("outcome") == "stored", F.col("_list")).when(F.col("outcome") == "not_encodable", empty)
        .otherwise(F.col("_old")).alias("makefiles"),
        F.when(F.col("outcome") == "stored", F.col("_length")).when(F.col("outcome") == "not_encodable", 0)
        .otherwise(F.col("_old_length")).cast("bigint").alias("stored"),
    )
    return new_state, marked.filter("outcome is not null").select(*REPO_KEY, "outcome")


def update_makefile_counts(state: DataFrame, updates: DataFrame, seq: str = "seq") -> DataFrame:
    """The same update when Makefiles are kept as rows of their own: only the counts change, all other columns stay."""
    new = latest(updates, REPO_KEY, F.col(seq), ["num_makefiles", "num_binaries"]).withColumn("_new", F.lit(True))
    joined = state.alias("s").join(new.alias("u"), REPO_KEY, "left")
    changed = {
        "compiled": F.coalesce(F.col("_new"), F.col("s.compiled")),
        "num_makefiles": F.coalesce("u.num_makefiles", "s.num_makefiles"),
        "num_binaries": F.coalesce("u.num_binaries", "s.num_binaries"),
    }
    rest = [c for c in state.columns if c not in REPO_KEY]
    return joined.select(*REPO_KEY, *[changed.get(c, F.col(f"s.{c}")).alias(c) for c in rest])


def add_binaries(state: DataFrame, updates: DataFrame, seq: str = "seq") -> DataFrame:
    """Insert binaries, or set only ``success`` of known ones; the first owner and name stay."""
    new = updates.groupBy("sha").agg(
        F.min_by(F.struct(*REPO_KEY), seq).alias("_first"), F.max_by("success", seq).alias("success")
    ).withColumn("_new", F.lit(True))
    old = state.withColumn("_old", F.lit(True))
    columns = [
        F.when(F.col("_old"), F.col(f"s.{c}")).otherwise(F.col(f"_first.{c}")).alias(c) for c in REPO_KEY
    ]
    columns.append(F.when(F.col("_new"), F.col("u.success")).otherwise(F.col("s.success")).alias("success"))
    return _merge(old, new, ["sha"], columns)


def add_match_results(state: DataFrame, updates: DataFrame, seq: str = "seq") -> DataFrame:
    """Insert or overwrite the four counters of a repository."""
    new = latest(updates, REPO_KEY, F.col(seq), MATCH_COUNTERS)
    return _merge(state, new, REPO_KEY, [F.coalesce(f"u.{c}", f"s.{c}").alias(c) for c in MATCH_COUNTERS])


def repo_updates(results: DataFrame, state: DataFrame) -> DataFrame:
    """What is written of each result: a repository update and / or a Makefile update.

    ``add_repo`` holds when the clone stage ran or the repository is unknown; size 0 or null is -1 and a missing
    clone state counts as a success, also after an unknown clone error.
    """
    known = state.select(*REPO_KEY).withColumn("_known", F.lit(True))
    joined = results.join(known, REPO_KEY, "left")
    return joined.select(
        *results.columns,
        (F.col("clone_success").isNotNull() | F.col("_known").isNull()).alias("add_repo"),
        F.coalesce("clone_success", F.lit(True)).alias("clone_successful"),
        F.coalesce(F.nullif(F.col("repo_size"), F.lit(0)), F.lit(-1)).cast("bigint").alias("stored_size"),
    )


def backfill_owners(state: DataFrame, mapping: DataFrame) -> DataFrame:
    """Set owner and name of legacy binaries from the mapping; ``action`` tells what happened to each."""
    joined = state.alias("s").join(mapping.alias("m"), "sha", "left")
    found, legacy = F.col("m.repo_owner").isNotNull(), F.col("s.repo_owner").isNull()
    action = F.when(found & legacy, "migrated").when(found, "skipped").otherwise("unlisted")
    return joined.select(
        "sha", *[F.coalesce(f"s.{c}", f"m.{c}").alias(c) for c in REPO_KEY], F.col("s.success").alias("success"),
        action.alias("action"),
    )


def violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; a key that is no column is an error."""
    unknown = [k for k in keys if k not in df.columns]
    if unknown:
        raise ValueError(f"index keys {unknown} are not in the schema")
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def lookup(state: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Entries for a table of keys."""
    return state.join(wanted.select(*keys), keys, "left_semi")


def binaries_of(state: DataFrame, owner: str, name: str, success: bool = True) -> DataFrame:
    return state.filter((F.col("repo_owner") == owner) & (F.col("repo_name") == name) & (F.col("success") == success))


def write_snapshot(df: DataFrame, base: str, version: int) -> str:
    """Write one version of a state; readers name the version, so a rerun only replaces its own folder."""
    path = f"{base}/v={version:012d}"
    df.write.mode("overwrite").parquet(path)
    return path
