"""Aggregations over the build, binary and match tables."""

from pyspark.sql import functions as F

from corpusflow.catalog.registry import query
from corpusflow.catalog.state import _MAPPING, nested_directory, nested_state, two_runs
from corpusflow.operators import joins, rollups
from corpusflow.operators.state import REPO_KEY, binaries_in
from corpusflow.sources import readers


@query("agg01_binary_mapping", _MAPPING + """
select sha, p.o as repo_owner, p.n as repo_name, p.o || '/' || p.n || '/' || sha as path,
    p.o || '/' || p.n || '/' || replace(p.d, '/usr/src/repo/', '') || '/' || p.p as path_in_repo from m""")
def _(v):
    return rollups.binary_mapping(v("makefile_binary"))


_NESTED = """
with n as (select repo_owner, repo_name, string_split(text, chr(10)) as lines from $nested_makefile),
m as (select repo_owner, repo_name, i - 1 as makefile_pos, string_split(line, ' ') as words from n, unnest(lines) with ordinality u(line, i)),
b as (select repo_owner, repo_name, makefile_pos, j - 1 as binary_pos, word from m, unnest(words) with ordinality u(word, j)
    where j <= case when len(words) > 3 then len(words) - 1 else len(words) end)"""


@query("agg01_nested_mapping", _NESTED + """
select sha256(word) as sha, max({'o': repo_owner, 'n': repo_name, 'm': makefile_pos, 'b': binary_pos})['o'] as repo_owner,
    max({'o': repo_owner, 'n': repo_name, 'm': makefile_pos, 'b': binary_pos})['n'] as repo_name,
    max({'o': repo_owner, 'n': repo_name, 'm': makefile_pos, 'b': binary_pos, 'p': 'm' || cast(makefile_pos as string) || '/' || word})['p'] as place
from b group by word""")
def _(v):
    rows, first = rollups.numbered_makefiles(v("nested_makefile"), F.size(F.split("text", "\n")))  # before the lists are made: texts are smaller
    mapping = rollups.nested_mapping(nested_state(v, rows=rows), first, nested_directory)
    return mapping.select("sha", "repo_owner", "repo_name", F.regexp_replace("path_in_repo", "^[^/]+/[^/]+/", "").alias("place"))


@query("agg02_decompiled_hashes", """
select distinct repo_owner, repo_name, sha from $binaries where success""")
def _(v):
    return rollups.decompiled_hashes(v("binaries"))


@query("agg03_compiled_totals", """
select cast(sum(num_makefiles) as bigint) as num_makefiles, cast(sum(num_binaries) as bigint) as num_binaries from $repos where compiled""")
def _(v):
    return rollups.compiled_totals(v("repos"))


@query("agg04_document_count", "select count(*) as n from $repos")
def _(v):
    return v("repos").agg(F.count("*").alias("n"))


@query("agg04_estimated_count", "select count(*) as n from documents")
def _(v):
    return readers.estimated_count(v.spark, f"{v.sf_dir}/documents.parquet")


@query("agg05_nested_counts", """
select repo_owner, repo_name, cast(len(string_split(text, chr(10))) as bigint) as num_makefiles,
    cast(list_sum(list_transform(string_split(text, chr(10)), lambda x: len(string_split(x, ' ')))) as bigint) as num_binaries
from $nested_makefile""")
def _(v):
    return nested_state(v).select(
        "repo_owner", "repo_name", F.size("makefiles").cast("bigint").alias("num_makefiles"),
        binaries_in(F.col("makefiles")).alias("num_binaries"),
    )


@query("agg06_compile_summary", """
with m as (select repo_owner, repo_name, directory, bool_or(success) as success, count(path) as n from $makefile_binary group by all),
k as (select repo_owner, repo_name, count(*) filter (where success) as n_success, count(*) filter (where success or n > 2) as n_partial, count(*) as n_total,
    cast(coalesce(sum(n) filter (where success or n > 2), 0) as bigint) as n_binaries from m group by all)
select *, case when n_success = n_total then 'success' else 'warning' end as level,
    printf('%d (%d) out of %d Makefile(s) in %s compiled (partially), yielding %d binaries', n_success, n_partial, n_total, repo_owner || '/' || repo_name, n_binaries) as line
from k""")
def _(v):
    made = rollups.makefile_outcomes(v("makefile_binary"), REPO_KEY)
    return rollups.compile_summary(made, REPO_KEY, F.expr("success or n_binaries > 2"))


@query("agg07_libraries_per_repo", r"""
select distinct repo_id, unnest(list_transform(regexp_extract_all(cmd, ' -l ?\S+'), lambda x: regexp_replace(x, '^ -l ?', ''))) as library
from $cc where rc <> 0""")
def _(v):
    from corpusflow.functions.ccommand import failed_libraries

    return failed_libraries(v("cc"), ["repo_id"]).distinct()


@query("agg08_corpus_rollup", """
with f as (select repo_owner, repo_name, directory, max_by(success, makefile_pos) as ok, cast(count(*) as bigint) as n from $makefile_binary group by all),
p as (select repo_owner, repo_name, count(*) filter (where ok) as ok, sum(n) as n from f group by all),
o as (select repo_owner, repo_name, count(*) filter (where success) as ok, count(*) as n from $makefile_binary group by all),
j as (select r.*, p.ok as new_ok, p.n as new_n, o.ok as old_ok, o.n as old_n from $results r
    left join p using (repo_owner, repo_name) left join o using (repo_owner, repo_name))
select count(*) as num_repos, count(*) filter (where num_binaries = 1) as num_gitmodules, cast(sum(num_makefiles) as bigint) as num_makefiles,
    cast(sum(without_ast) as bigint) as makefiles_using_automake, cast(sum(case when has_makefiles then new_ok else old_ok end) as bigint) as success_makefiles,
    cast(sum(case when has_makefiles then new_n else old_n end) as bigint) as num_binaries from j""")
def _(v):
    rows = v("makefile_binary").select(*REPO_KEY, "directory", "makefile_pos", "success", F.lit(1).alias("n_binaries"))
    results = v("results").select(
        *REPO_KEY, "has_makefiles", "num_makefiles", (F.col("num_binaries") == 1).alias("has_gitmodules"),
        F.col("without_ast").alias("makefiles_using_automake"),
    )
    return rollups.corpus_rollup(results, rows, rows)


@query("agg09_makefile_transitions", """
with o as (select repo_name, directory, bool_or(path like '%1.o') as o from $makefile_binary where built < timestamp '1999-01-01 00:00:00' group by all),
n as (select repo_name, directory, bool_or(path like '%2.o') as n from $makefile_binary where built >= timestamp '1998-06-01 00:00:00' group by all)
select count(*) filter (where n and not o) as fail_to_success, count(*) filter (where o and not n) as success_to_fail,
    count(*) filter (where n and o is null) as added_makefiles, count(*) filter (where o and n is null) as missing_makefiles
from o full join n using (repo_name, directory)""")
def _(v):
    old, new = two_runs(v, "repo_name", "directory", "path")
    keys = ["repo_name", "directory"]
    return rollups.makefile_transitions(
        old.groupBy(*keys).agg(F.bool_or(F.col("path").endswith("1.o")).alias("success")),
        new.groupBy(*keys).agg(F.bool_or(F.col("path").endswith("2.o")).alias("success")), keys,
    )


@query("agg10_match_totals", """
select count(*) as repos, cast(sum(funcs_matched) as bigint) as matched, cast(sum(funcs_matched_without_ast) as bigint) as without_ast from $match_func""")
def _(v):
    return rollups.match_totals(v("match_func"))


@query("agg17_files_per_repo", "select repo_owner, repo_name, count(*) as total_files from $makefile_binary group by all")
def _(v):
    return v("makefile_binary").groupBy(*REPO_KEY).agg(F.count("*").alias("total_files"))


@query("agg17_claimed_files_per_repo", """
with c as (select repo_owner, repo_name, sha, min(makefile_pos * 100000000000 + binary_pos) as place, min_by(directory, makefile_pos * 100000000000 + binary_pos) as directory,
    min_by(path, makefile_pos * 100000000000 + binary_pos) as path
    from $makefile_binary m where exists (select 1 from $binaries b where b.repo_owner = m.repo_owner and b.repo_name = m.repo_name and b.sha = m.sha and b.success) group by all),
d as (select *, floor(place / 100000000000) as makefile_pos from c),
l as (select repo_owner, repo_name, directory, max(makefile_pos) as makefile_pos from d group by all),
w as (select distinct repo_owner, repo_name, directory, path from d semi join l using (repo_owner, repo_name, directory, makefile_pos))
select repo_owner, repo_name, count(*) as total_files from w group by all""")
def _(v):
    return joins.work_items(v("makefile_binary"), v("binaries")).groupBy(*REPO_KEY).agg(F.count("*").alias("total_files"))


@query("agg18_makefile_dirs", "select distinct repo_id, dir from $files where lower(file) = 'makefile'")
def _(v):
    return rollups.makefile_dirs(v("files"), ["repo_id"])


@query("agg18_repos_without_makefiles", "select repo_id from $files group by repo_id having not bool_or(lower(file) = 'makefile')")
def _(v):
    return rollups.without_makefiles(v("files"), ["repo_id"])


@query("agg19_repo_meta", """
with d as (select repo_id, dir, bool_or(lower(file) = 'makefile') as m, bool_or(lower(file) in ('configure.ac', 'configure.in')) as a,
    bool_or(is_root and file = '.gitmodules') as g from $files group by all)
select repo_id, count(*) filter (where m) as num_makefiles, bool_or(g) as has_gitmodules, count(*) filter (where m and a) as makefiles_using_automake
from d group by repo_id""")
def _(v):
    return rollups.repo_meta(v("files"), ["repo_id"], F.col("is_root"))


@query("agg20_outcome_counts", """
select case when success is null then 'TimedOut' when repo_owner is null then 'NoVariables' when not success then 'UnknownError' else 'Success' end as status,
    count(*) as n from $binaries group by all""")
def _(v):
    from corpusflow.plans.decompile_run import classify_attempts

    attempts = v("binaries").select(
        "sha", F.lit(False).alias("timed_out"), F.when(F.col("repo_owner").isNull(), 0).otherwise(3).alias("variables"),
        (~F.col("success")).alias("failed"),
    )
    nothing = v("binaries").filter(F.lit(False))
    return rollups.status_counts(classify_attempts(attempts, nothing), "status")


@query("agg20_all_outcomes", """
with s as (select sha, case when sha < '4' then 'Success' when sha < '8' then 'TimedOut' when repo_owner is null then 'NoVariables' when not success then 'UnknownError'
    else 'Success' end as status from $binaries)
select status, status = 'Success' as success, count(*) as n from s group by all""")
def _(v):
    from corpusflow.plans.decompile_run import classify_attempts

    binaries = v("binaries")
    attempts = binaries.select(
        "sha", (F.col("sha") < "8").alias("timed_out"), F.when(F.col("repo_owner").isNull(), 0).otherwise(3).alias("variables"), (~F.col("success")).alias("failed"),
    )
    found = classify_attempts(attempts, binaries.filter("sha < '4'").select("sha"))
    return found.withColumn("success", F.col("status") == "Success").groupBy("status", "success").agg(F.count("*").alias("n"))
