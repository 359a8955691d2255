"""Projections, filters and classification."""

from pyspark.sql import functions as F

from corpusflow.catalog.registry import query
from corpusflow.functions import names, outcomes
from corpusflow.operators import rollups
from corpusflow.operators.ordered import from_key_on

_SEGMENTS = r"string_split(regexp_replace(rtrim(trim(line), '/'), '\.git$', ''), '/')"


@query("prj01_repo_names", f"""
select idx, {_SEGMENTS}[-2] as repo_owner, {_SEGMENTS}[-1] as repo_name from $repo_list where len({_SEGMENTS}) >= 2""")
def _(v):
    line = F.col("line")
    named = v("repo_list").select("idx", names.repo_owner(line).alias("repo_owner"), names.repo_name(line).alias("repo_name"))
    return named.filter("repo_owner is not null")


@query("prj02_repo_folders", """
select repo_owner || '/' || repo_name as full_name, repo_owner || '_____' || repo_name as folder_name,
    'archives/' || repo_owner || '/' || repo_name || case when num_makefiles % 2 = 0 then '.tar.gz' else '.tar.xz' end as archive
from $repos""")
def _(v):
    owner, name = F.col("repo_owner"), F.col("repo_name")
    kind = F.when(F.col("num_makefiles") % 2 == 0, "gzip").otherwise("xz")
    return v("repos").select(
        names.full_name(owner, name).alias("full_name"), names.folder_name(owner, name).alias("folder_name"),
        names.archive_path("archives", owner, name, kind).alias("archive"),
    )


@query("prj03_work_plan", """
with t as (select w.idx, r.repo_owner is not null as known, coalesce(r.clone_successful, false) as cloned,
    coalesce(r.compiled, false) as compiled, w.idx % 5 = 0 as archived, w.idx % 4 = 0 as folder
    from (select idx, 'c' || cast(idx % 1000 as string) as o, 'r' || cast(idx as string) as n from $repo_list where trim(line) <> '') w
    left join $repos_before r on r.repo_owner = w.o and r.repo_name = w.n),
p as (select *, case when known and cloned and compiled then 'skip' when archived then 'extract'
    when not known or (cloned and not compiled and not folder) then 'clone' when not cloned then 'dummy' else 'reuse' end as source from t)
select idx, source, source not in ('skip', 'dummy') and (not known or not compiled) as needs_compile from p""")
def _(v):
    from corpusflow.plans.build_run import plan_work

    inventory = F.col("idx") % 5 == 0, F.col("idx") % 4 == 0
    return plan_work(v("repo_list"), v("repos_before"), *inventory).select("idx", "source", "needs_compile")


@query("prj04_paths_in_repo", """
select sha, repo_owner || '/' || repo_name || '/' || regexp_replace(directory, '^/usr/src/repo/', '') || '/' || path as path_in_repo,
    regexp_replace(directory, '^/usr/src/repo/', '') as relative,
    array_to_string(list_slice(string_split(directory, '/'), 5, 1000), '/') as tail
from $makefile_binary""")
def _(v):
    directory = F.col("directory")
    return v("makefile_binary").select(
        "sha",
        names.path_in_repo(F.col("repo_owner"), F.col("repo_name"), directory, F.col("path")).alias("path_in_repo"),
        names.relative_to(directory, "/usr/src/repo").alias("relative"),
        names.drop_segments(directory, 4).alias("tail"),
    )


@query("prj05_hash_keys", "select path, string_split(path, '/')[-1] as file from $makefile_binary")
def _(v):
    return v("makefile_binary").select("path", names.last_segment(F.col("path")).alias("file"))


@query("prj06_content_hashes", "select doc_id, sha256(text) as sha from documents")
def _(v):
    return v("documents").select("doc_id", names.content_hash(F.col("text").cast("binary")).alias("sha"))


@query("fil01_elf_files", """
select l_orderkey, l_linenumber, l_partkey, l_returnflag = 'R' as is_elf from lineitem""")
def _(v):
    content = F.concat(
        F.when(F.col("l_returnflag") == "R", F.unhex(F.lit("7F454C46"))).otherwise(F.unhex(F.lit("2321"))),
        F.col("l_partkey").cast("string").cast("binary"),
    )
    files = v("lineitem").withColumn("content", content)
    return files.select("l_orderkey", "l_linenumber", "l_partkey", names.is_elf(F.col("content")).alias("is_elf"))


@query("fil02_recorded_makefiles", """
select repo_name, directory, bool_or(success) as success, count(*) filter (where sha like '%0') as n_binaries
from $makefile_binary group by all having bool_or(success) or count(*) filter (where sha like '%0') > 0""")
def _(v):
    grouped = v("makefile_binary").groupBy("repo_name", "directory").agg(
        F.bool_or("success").alias("success"), F.count_if(F.col("sha").endswith("0")).alias("n_binaries")
    )
    return grouped.filter(outcomes.recorded(F.col("success"), F.col("n_binaries")))


@query("fil03_archive_size", "select repo_owner, repo_name, repo_size from $repos where repo_size <= 104857600")
def _(v):
    kept = v("repos").filter(outcomes.within_size(F.col("repo_size"), 100 * 1024 * 1024))
    return kept.select("repo_owner", "repo_name", "repo_size")


@query("fil04_first_line", "select doc_id, contains(string_split(text, chr(10))[1], 'the') as found from documents")
def _(v):
    return v("documents").select("doc_id", names.first_line_contains(F.col("text"), "the").alias("found"))


@query("fil05_eligible_repos", """
select repo_owner, repo_name from $repos where clone_successful and compiled and num_makefiles <> 0 and num_binaries <> 0""")
def _(v):
    wanted = outcomes.eligible(F.col("clone_successful"), F.col("compiled"), F.col("num_makefiles"), F.col("num_binaries"))
    return v("repos").filter(wanted).select("repo_owner", "repo_name")


@query("fil06_skip_until", """
select idx, line from $repo_list where idx >= (select min(idx) from $repo_list where line like '%c77/r77')""")
def _(v):
    return from_key_on(v("repo_list"), F.col("line").endswith("c77/r77"), "idx", inclusive=True)


@query("fil06_skip_after", """
select idx, line from $repo_list where idx > (select min(idx) from $repo_list where line like '%c77/r77')""")
def _(v):
    return from_key_on(v("repo_list"), F.col("line").endswith("c77/r77"), "idx", inclusive=False)


@query("fil07_valid_text", "select doc_id from documents where lang <> 'de'")
def _(v):
    # German texts get a stray byte, which makes them undecodable.
    content = F.concat(F.col("text").cast("binary"), F.when(F.col("lang") == "de", F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit(""))))
    return rollups.decodable(v("documents").select("doc_id", content.alias("content")), "content").select("doc_id")


@query("fil08_build_systems", """
select repo_id, dir, bool_or(lower(file) = 'makefile') as has_make, bool_or(lower(file) in ('configure.ac', 'configure.in')) as has_autotools,
    bool_or(file = 'configure') as has_configure, bool_or(file = 'autogen.sh') as has_autogen, bool_or(file = '.gitmodules') as has_gitmodules
from $files group by repo_id, dir""")
def _(v):
    return rollups.build_systems(v("files"), ["repo_id"])


@query("cls01_clone_outcome", """
select id, not folder_exists and not timed_out and exited_ok as success, case when folder_exists then 'FolderExists'
    when timed_out then 'Timeout' when exited_ok and submodule_failed then 'SubmodulesFailed' when exited_ok then null
    when contains(output, 'could not read Username') or contains(output, 'Repository not found.') then 'PrivateOrNonexistent'
    else 'Unknown' end as error from $clone_log""")
def _(v):
    columns = [F.col(c) for c in ["folder_exists", "exited_ok", "timed_out", "output", "submodule_failed"]]
    success, error = outcomes.clone_outcome(*columns)
    return v("clone_log").select("id", success.alias("success"), error.alias("error"))


@query("cls02_make_outcome", """
select repo_id, seq, cmd, case when seq = 7 then 'Timeout' when seq = 6 then 'Unknown' when rc <> 0 then 'CompileFailed' end as error,
    seq < 6 and rc <> 0 and contains(cmd, '-DX=1') as retry, seq > 5 or contains(cmd, '-lA') as suppressed
from (select *, case when contains(cmd, '-DX=1') then 'missing separator' else '' end || case when contains(cmd, '-lA')
    then 'Resource temporarily unavailable' else '' end as output from $cc)""")
def _(v):
    output = F.concat(
        F.when(F.col("cmd").contains("-DX=1"), "*** missing separator.  Stop.").otherwise(""),
        F.when(F.col("cmd").contains("-lA"), "fork: Resource temporarily unavailable").otherwise(""),
    )
    error, retry = outcomes.make_outcome(F.col("seq") == 7, F.col("rc"), F.col("seq") == 6, output)
    suppressed = outcomes.batch_suppressed(F.col("seq") * 180.0, F.lit(900.0), output)
    return v("cc").select("repo_id", "seq", "cmd", error.alias("error"), retry.alias("retry"), suppressed.alias("suppressed"))


@query("cls03_decompile_outcome", """
with d as (select distinct sha from $decompiled)
select b.sha, case when d.sha is not null then 'Success' when b.success is null then 'TimedOut'
    when b.repo_owner is null then 'NoVariables' when not b.success then 'UnknownError' else 'Success' end as status
from $binaries b left join d using (sha)""")
def _(v):
    from corpusflow.plans.decompile_run import classify_attempts

    attempts = v("binaries").select(
        "sha", F.col("success").isNull().alias("timed_out"),
        F.when(F.col("repo_owner").isNull(), 0).otherwise(3).alias("variables"), (~F.col("success")).alias("failed"),
    )
    present = v("decompiled").select("sha")
    return classify_attempts(attempts, present).select("sha", "status")


@query("cls04_match_status", """
select repo_owner, repo_name, case when files_found % 2 = 0 and funcs_matched > 0 then 'success'
    when files_found % 2 = 0 or funcs_matched > 0 then 'warning' else 'error' end as status from $match_func""")
def _(v):
    status = outcomes.match_status(F.col("files_found") % 2 == 1, F.col("funcs_matched"))
    return v("match_func").select("repo_owner", "repo_name", status.alias("status"))
