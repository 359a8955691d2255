"""State tables and set operations."""

from pyspark.sql import functions as F

from corpusflow.catalog.registry import query
from corpusflow.operators import logs, rollups, state

_LIST = "list_transform(string_split(text, chr(10)), lambda line: string_split(line, ' '))"


def nested_directory(i):
    return F.concat(F.lit("/usr/src/repo/m"), i.cast("string"))


def nested_state(v, trimmed: bool = False, rows=None):
    """Repositories with nested Makefiles, built inside each row: lines are Makefiles, words are binaries. ``rows`` may stand for those of the view, with more columns."""
    rows = v("nested_makefile") if rows is None else rows

    def makefile(line, i):
        binaries = F.split(line, " ")
        hashes = F.transform(binaries, lambda b: F.sha2(b, 256))
        short = F.when(F.size(hashes) > 3, F.slice(hashes, F.lit(1), F.size(hashes) - 1)).otherwise(hashes)
        return F.struct(
            nested_directory(i).alias("directory"), (i % 3 != 1).alias("success"),
            binaries.alias("binaries"), short.alias("sha256"),
        )

    return rows.select(
        "repo_owner", "repo_name", "lang", F.transform(F.split("text", "\n"), makefile).alias("makefiles"),
        *[c for c in rows.columns if c not in ("repo_owner", "repo_name", "lang", "text")],
    )


@query("ups01_add_repos", """
with u as (select repo_owner, repo_name, coalesce(clone_success, true) as clone_successful, coalesce(repo_size, -1) as repo_size, true as n from $results)
select coalesce(s.repo_owner, u.repo_owner) as repo_owner, coalesce(s.repo_name, u.repo_name) as repo_name,
    case when n then u.repo_size else s.repo_size end as repo_size,
    case when n then u.clone_successful else s.clone_successful end as clone_successful, coalesce(s.compiled, false) as compiled,
    coalesce(s.num_makefiles, 0) as num_makefiles, coalesce(s.num_binaries, 0) as num_binaries
from $repos_before s full join u on s.repo_owner = u.repo_owner and s.repo_name = u.repo_name""")
def _(v):
    updates = v("results").withColumn("clone_successful", F.coalesce("clone_success", F.lit(True)))
    return state.add_repos(v("repos_before"), updates)


@query("ups01_last_update_wins", """
select 'g' || cast(repo_size % 10 as string) as repo_owner, 'all' as repo_name, max(seq) as repo_size,
    max_by(clone_success is not null, seq) as clone_successful, false as compiled, cast(0 as bigint) as num_makefiles, cast(0 as bigint) as num_binaries
from $results where repo_size is not null group by repo_size % 10""")
def _(v):
    many = v("results").filter("repo_size is not null").select(
        F.concat(F.lit("g"), (F.col("repo_size") % 10).cast("string")).alias("repo_owner"), F.lit("all").alias("repo_name"),
        F.col("clone_success").isNotNull().alias("clone_successful"), F.col("seq").alias("repo_size"), "seq",
    )
    nothing = v("repos_before").filter(F.lit(False))
    return state.add_repos(nothing, many)


_UPS02 = f"""
with d as (select *, {_LIST} as lines from $nested_makefile),
j as (select repo_owner, repo_name, len(lines) as new_len, cast(list_sum(list_transform(lines, lambda w: len(w))) as bigint) as new_bins,
    case lang when 'en' then 0 when 'fr' then len(lines) else len(lines) + 1 end as old_len from d)"""


def _makefile_update(v):
    nested = nested_state(v)
    old = F.when(F.col("lang") == "en", F.slice("makefiles", F.lit(1), F.lit(0))).when(
        F.col("lang") == "fr", F.col("makefiles")
    ).otherwise(F.concat("makefiles", F.slice("makefiles", F.lit(1), F.lit(1))))
    stored = nested.select(
        "repo_owner", "repo_name", F.lit(1).cast("bigint").alias("repo_size"), F.lit(True).alias("clone_successful"),
        F.lit(False).alias("compiled"), F.size(old).cast("bigint").alias("num_makefiles"),
        F.lit(0).cast("bigint").alias("num_binaries"), old.alias("makefiles"),
    )
    updates = nested.select("repo_owner", "repo_name", "makefiles", F.lit(1).alias("seq"))
    extra = updates.filter("repo_name like '%7'").withColumn("repo_owner", F.lit("nobody"))
    return state.update_makefiles(stored, updates.unionByName(extra))


@query("ups02_update_makefiles", _UPS02 + """
select repo_owner, repo_name, old_len in (0, new_len) as compiled, case when old_len in (0, new_len) then new_len else old_len end as num_makefiles,
    case when old_len in (0, new_len) then new_bins else 0 end as num_binaries, cast(case when old_len in (0, new_len) then new_len else old_len end as bigint) as stored
from j""")
def _(v):
    new, _report = _makefile_update(v)
    return new.select("repo_owner", "repo_name", "compiled", "num_makefiles", "num_binaries", "stored")


@query("ups02_update_report", _UPS02 + """
select repo_owner, repo_name, case when old_len in (0, new_len) then 'stored' else 'length_mismatch' end as outcome from j
union all select 'nobody', repo_name, 'unknown_repo' from (select distinct repo_name from j where repo_name like '%7')""")
def _(v):
    return _makefile_update(v)[1]


@query("ups03_add_binaries", """
with u as (select sha, min_by(repo_owner, k) as repo_owner, min_by(repo_name, k) as repo_name, max_by(success, k) as success
    from (select *, cast(substr(repo_name, 2) as bigint) * 8 + makefile_pos as k from $makefile_binary) group by sha)
select coalesce(s.sha, u.sha) as sha, case when s.sha is not null then s.repo_owner else u.repo_owner end as repo_owner,
    case when s.sha is not null then s.repo_name else u.repo_name end as repo_name,
    case when u.sha is not null then u.success else s.success end as success
from $binaries_before s full join u on s.sha = u.sha""")
def _(v):
    seq = F.substr("repo_name", F.lit(2)).cast("bigint") * 8 + F.col("makefile_pos")
    return state.add_binaries(v("binaries_before"), v("makefile_binary").withColumn("seq", seq))


@query("ups04_add_match_results", """
with u as (select repo_owner, repo_name, num_makefiles as a, num_makefiles + 3 as b, funcs_matched as c, without_ast as d from $results)
select coalesce(s.repo_owner, u.repo_owner) as repo_owner, coalesce(s.repo_name, u.repo_name) as repo_name, coalesce(a, files_found) as files_found,
    coalesce(b, funcs_found) as funcs_found, coalesce(c, s.funcs_matched) as funcs_matched, coalesce(d, funcs_matched_without_ast) as funcs_matched_without_ast
from $match_func_before s full join u on s.repo_owner = u.repo_owner and s.repo_name = u.repo_name""")
def _(v):
    updates = v("results").select(
        "repo_owner", "repo_name", "seq", F.col("num_makefiles").alias("files_found"),
        (F.col("num_makefiles") + 3).alias("funcs_found"), "funcs_matched", F.col("without_ast").alias("funcs_matched_without_ast"),
    )
    return state.add_match_results(v("match_func_before"), updates)


@query("ups05_result_decisions", """
select r.seq, r.clone_success is not null or s.repo_owner is null as add_repo, coalesce(r.clone_success, true) as clone_successful,
    coalesce(nullif(r.repo_size, 0), -1) as stored_size, r.has_makefiles
from $results r left join $repos_before s on s.repo_owner = r.repo_owner and s.repo_name = r.repo_name""")
def _(v):
    decided = state.repo_updates(v("results"), v("repos_before"))
    return decided.select("seq", "add_repo", "clone_successful", "stored_size", "has_makefiles")


_MAPPING = """
with m as (select sha, max({'o': repo_owner, 'n': repo_name, 'm': makefile_pos, 'b': binary_pos, 'd': directory, 'p': path}) as p from $makefile_binary group by sha)"""


@query("ups06_backfill_owners", _MAPPING + """
select b.sha, coalesce(b.repo_owner, p.o) as repo_owner, coalesce(b.repo_name, p.n) as repo_name, b.success,
    case when p is null then 'unlisted' when b.repo_owner is null then 'migrated' else 'skipped' end as action
from $binaries b left join m on m.sha = b.sha""")
def _(v):
    return state.backfill_owners(v("binaries"), rollups.binary_mapping(v("makefile_binary")))


@query("ups06_backfill_counts", """
select case when repo_owner is null then 'migrated' else 'skipped' end as action, count(*) as n from $binaries group by all""")
def _(v):
    filled = state.backfill_owners(v("binaries"), rollups.binary_mapping(v("makefile_binary")))
    return rollups.status_counts(filled, "action")


@query("ups07_unique_violations", """
select repo_owner, repo_name, directory, count(*) as rows from $makefile_binary group by all having count(*) > 1""")
def _(v):
    return state.violations(v("makefile_binary"), ["repo_owner", "repo_name", "directory"])


@query("ups08_lookup", """
select repo_owner, repo_name, repo_size from $repos where (repo_owner, repo_name) in (select repo_owner, repo_name from $results where clone_success is null)""")
def _(v):
    wanted = v("results").filter("clone_success is null")
    found = state.lookup(v("repos"), wanted, state.REPO_KEY)
    return found.select("repo_owner", "repo_name", "repo_size")


@query("ups08_binaries_of_repo", "select sha, success from $binaries where repo_owner = 'c1' and repo_name = 'r1' and success")
def _(v):
    return state.binaries_of(v("binaries"), "c1", "r1").select("sha", "success")


_LIBS = "select distinct lib as library from $lib_req"


@query("set01_library_union", """
select l_returnflag || cast(l_suppkey as string) as library from lineitem union select lib from $lib_req""")
def _(v):
    log = v("lineitem").select(F.concat("l_returnflag", F.col("l_suppkey").cast("string")).alias("value"))
    earlier = rollups.library_words(v("lib_req").withColumnRenamed("lib", "value"))
    return earlier.union(rollups.library_words(log)).distinct()


_SNAP = r"""
with o as (select distinct regexp_extract(line, 'in (u\d+/r-\d+)', 1) as repo from $compile_log_old where line not like 'noise%'),
n as (select distinct regexp_extract(line, 'in (u\d+/r-\d+)', 1) as repo from $compile_log_new where line not like 'noise%')"""


@query("set02_missing_repos", _SNAP + """
select repo, 'NEW' as missing_in from o where repo not in (select repo from n) union all
select repo, 'OLD' from n where repo not in (select repo from o)""")
def _(v):
    return logs.missing_repos(logs.snapshot(v("compile_log_old")), logs.snapshot(v("compile_log_new")))


@query("set02_snapshot_sizes", _SNAP + "select (select count(*) from o) as old_size, (select count(*) from n) as new_size")
def _(v):
    return logs.snapshot_sizes(logs.snapshot(v("compile_log_old")), logs.snapshot(v("compile_log_new")))


_RUNS = """
with o as (select distinct repo_name, directory from $makefile_binary where built < timestamp '1999-01-01 00:00:00'),
n as (select distinct repo_name, directory from $makefile_binary where built >= timestamp '1998-06-01 00:00:00')"""


def two_runs(v, *columns):
    """Makefiles of an older and a newer build run; the runs overlap."""
    rows = v("makefile_binary")
    old = rows.filter("built < timestamp '1999-01-01 00:00:00'").select(*columns)
    return old, rows.filter("built >= timestamp '1998-06-01 00:00:00'").select(*columns)


@query("set03_kept_makefiles", _RUNS + "select * from o intersect select * from n")
def _(v):
    old, new = two_runs(v, "repo_name", "directory")
    return old.intersect(new)


@query("set03_dropped_makefiles", _RUNS + "select * from o except select * from n")
def _(v):
    old, new = two_runs(v, "repo_name", "directory")
    return old.subtract(new)


@query("set03_added_makefiles", _RUNS + "select * from n except select * from o")
def _(v):
    old, new = two_runs(v, "repo_name", "directory")
    return new.subtract(old)
