"""Sources and sinks. Each query stages files from the given tables, then reads them with the library."""

from pyspark.sql import functions as F

from corpusflow.catalog.code import RECORD_FIELDS, RUN, match_run_of, record_columns
from corpusflow.catalog.registry import query
from corpusflow.catalog.state import nested_state
from corpusflow.functions import ccode, names
from corpusflow.operators import rollups
from corpusflow.session import working_path
from corpusflow.sources import readers, writers

DICTIONARY_BYTES = 64 << 20


def staged_text(v, name, df):
    path = working_path(v.spark, name)
    df.write.text(path)
    return path


def staged_parquet(v, name, df):
    """Rows as Parquet; nested lists repeat many long hashes, which the stronger compression and larger dictionaries keep small."""
    path = working_path(v.spark, name)
    df.write.option("compression", "zstd").option("parquet.dictionary.page.size", str(DICTIONARY_BYTES)).parquet(path)
    return path


def _page_files(v):
    """One file per page, with its number in the path."""
    path = working_path(v.spark, "pages")
    writers.file_per_row(v("pages"), "page_id", "html", path)
    return path


def _page(of):
    return F.nullif(F.regexp_extract(of, "page_id=([0-9]+)(?:[-/]|$)", 1), F.lit("")).cast("bigint").alias("page_id")


@query("src01_repo_list", "select idx, line from $repo_list")
def _(v):
    listed = v("repo_list").repartitionByRange("idx").sortWithinPartitions("idx").select("line")
    return readers.repo_list(v.spark, staged_text(v, "repos", listed))


@query("src01_rejected_lines", "select idx, line from $repo_list where trim(line) = ''")
def _(v):
    from corpusflow.plans.build_run import named_repos

    listed = v("repo_list").repartitionByRange("idx").sortWithinPartitions("idx").select("line")
    return named_repos(readers.repo_list(v.spark, staged_text(v, "repos", listed)))[1]


@query("src02_repo_states", """
with n as (select repo_owner, repo_name, string_split(text, chr(10)) as lines from $nested_makefile),
m as (select repo_owner, repo_name, i - 1 as makefile_pos, string_split(line, ' ') as words from n, unnest(lines) with ordinality u(line, i))
select repo_owner, repo_name, makefile_pos, j - 1 as binary_pos, '/usr/src/repo/m' || cast(makefile_pos as string) as directory,
    makefile_pos % 3 <> 1 as success, word as path, sha256(word) as sha
from m, unnest(words) with ordinality u(word, j) where j <= case when len(words) > 3 then len(words) - 1 else len(words) end""")
def _(v):
    states = nested_state(v).select("repo_owner", "repo_name", F.lit(True).alias("compiled"), "makefiles")
    return rollups.exploded_makefiles(readers.repo_states(v.spark, staged_parquet(v, "repo-states", states)))


@query("src03_binary_states", "select sha, repo_owner, repo_name, success from $binaries")
def _(v):
    path = working_path(v.spark, "binary-states")
    state = v("binaries")
    # Legacy entries were written without owner columns.
    state.filter("repo_owner is null").select("sha", "success").write.mode("append").parquet(path)
    state.filter("repo_owner is not null").write.mode("append").parquet(path)
    return readers.binary_states(v.spark, path)


@query("src04_match_states", "select * from $match_func")
def _(v):
    return readers.match_states(v.spark, staged_parquet(v, "match-states", v("match_func")))


_SUPPLIER_LINE = """'{"function":"f' || cast(l_orderkey as string) || '","raw_code":"' || cast(l_partkey as string) || '"}'"""


@query("src05_decompiled_lines", f"""
select md5(cast(l_suppkey as string)) as sha, {_SUPPLIER_LINE} as line, count(*) as n from lineitem group by all""")
def _(v):
    path = working_path(v.spark, "decompiled")
    rows = v("lineitem").select(
        F.md5(F.col("l_suppkey").cast("string")).alias("sha"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_pos"), F.expr(_SUPPLIER_LINE).alias("line"),
    )
    blank = rows.select("sha").distinct().select("sha", F.lit(-1).cast("bigint").alias("line_pos"), F.lit("").alias("line"))
    writers.decompiled_lines(rows.unionByName(blank), path)
    return readers.stored_lines(v.spark, path).groupBy("sha", "line").agg(F.count("*").alias("n"))


@query("src08_file_inventory", "select page_id, strlen(html) + 1 as length from pages")
def _(v):
    found = readers.file_inventory(v.spark, _page_files(v)).filter("file like '%.txt'")
    return found.select(_page(F.concat_ws("/", "dir", "file")), "length")


@query("src09_file_hashes", "select page_id, sha256(html || chr(10)) as sha, false as is_elf from pages")
def _(v):
    content = F.col("content")
    return readers.binary_files(v.spark, _page_files(v), lambda files: files.filter("path like '%.txt'").select(
        _page("path"), names.content_hash(content).alias("sha"), names.is_elf(content).alias("is_elf"),
    ))


@query("src10_source_texts", "select page_id, md5(html || chr(10)) as digest, length(html) + 1 as n_chars from pages")
def _(v):
    return readers.source_files(v.spark, _page_files(v), lambda files: files.filter("path like '%.txt'").select(
        _page("path"), F.md5("code").alias("digest"), F.length("code").cast("bigint").alias("n_chars"),
    ))


@query("src11_tolerant_results", """
select repo_owner, repo_name, case when lang = 'de' then cast(0 as bigint) else cast(len(string_split(text, chr(10))) as bigint) end as num_makefiles from $nested_makefile""")
def _(v):
    nested = nested_state(v)
    written = nested.filter("lang <> 'de'").select("repo_owner", "repo_name", "makefiles")
    results = readers.repo_results(v.spark, staged_parquet(v, "results", written), nested.select("repo_owner", "repo_name"))
    return results.select("repo_owner", "repo_name", "num_makefiles")


@query("src12_untracked_files", """
select doc_id, unnest(list_transform(list_filter(string_split(text || chr(10) || '"' || source || ' é"' || chr(10), chr(10)), lambda x: x <> ''),
    lambda x: case when starts_with(x, '"') then substr(x, 2, greatest(length(x) - 2, 0)) else x end)) as file from documents""")
def _(v):
    output = F.concat("text", F.lit('\n"'), "source", F.lit(' \\351"\n'))
    return readers.untracked(v("documents"), ["doc_id"], output)


@query("snk01_matched_functions", RUN + " select * from rec")
def _(v):
    path = working_path(v.spark, "matched")
    rows = match_run_of(v)[0]
    writers.matched_functions(rows.select("repo_owner", "repo_name", F.from_json("record", RECORD_FIELDS).alias("r")).select("repo_owner", "repo_name", "r.*"), path)
    back = readers.stored_matches(v.spark, path, RECORD_FIELDS)
    return back.select("repo_owner", "repo_name", *record_columns(F.struct(*[c for c in back.columns if c not in ("repo_owner", "repo_name")])))


@query("snk02_source_corpus", """
select 'o' || substr(sha, 1, 1) as repo_owner, sha, md5(split_part(code, 'typedef int __end_of_fake_libc__;', 2)) as digest from $c_source""")
def _(v):
    path = working_path(v.spark, "sources")
    owned = v("c_source").select(
        F.concat(F.lit("o"), F.substring("sha", 1, 1)).alias("repo_owner"), F.col("file_id").cast("string").alias("repo_name"),
        "sha", ccode.without_header(F.col("code")).alias("code"),
    )
    writers.source_corpus(owned, path)
    return v.spark.read.parquet(path).select("repo_owner", "sha", F.md5("code").alias("digest"))


@query("snk03_makefile_report", """
select repo_name as "Repo", directory as "Makefile", case when bool_or(success) then null else 'Failed' end as "Status", cast(null as varchar) as "Failed Reason?"
from $makefile_binary group by all""")
def _(v):
    path = working_path(v.spark, "report")
    made = v("makefile_binary").groupBy(F.col("repo_name").alias("repo"), F.col("directory").alias("dir")).agg(
        F.when(F.bool_or("success"), "").otherwise("Failed").alias("status")
    )
    writers.makefile_report(made, path)
    return v.spark.read.option("header", "true").csv(path)


@query("snk04_library_list", "select distinct 'l' || cast(l_suppkey as string) as value from lineitem")
def _(v):
    path = working_path(v.spark, "library-list")
    writers.libraries(v("lineitem").select(F.concat(F.lit("l"), F.col("l_suppkey").cast("string")).alias("library")), path)
    return v.spark.read.text(path)


@query("snk05_decompiled_functions", """
select sha, func_name as function, raw_code, '{"node_id":' || cast(line_pos as string) || '}' as ast from $decompiled""")
def _(v):
    path = working_path(v.spark, "functions")
    tree = F.concat(F.lit('{"node_id":'), F.col("line_pos").cast("string"), F.lit("}")).alias("ast")
    writers.decompiled_functions(v("decompiled").select("sha", F.col("func_name").alias("function"), tree, "raw_code"), path)
    return readers.stored_functions(v.spark, path).select("sha", "function", "raw_code", "ast")


@query("stm01_streamed_state", """
with n as (select r.*, s.repo_owner as so, coalesce(s.compiled, false) as sc, coalesce(s.num_makefiles, 0) as sm, coalesce(s.num_binaries, 0) as sb,
    s.repo_size as ss, s.clone_successful as sk, r.clone_success is not null or s.repo_owner is null as added
    from $results r left join $repos_before s using (repo_owner, repo_name))
select repo_owner, repo_name, case when added then coalesce(nullif(repo_size, 0), -1) else ss end as repo_size,
    case when added then coalesce(clone_success, true) else sk end as clone_successful, has_makefiles or sc as compiled,
    case when has_makefiles then num_makefiles else sm end as num_makefiles, case when has_makefiles then num_binaries else sb end as num_binaries from n""")
def _(v):
    return _streamed(v).latest()


@query("stm01_streamed_totals", """
select count(*) as results, cast(sum(funcs_matched) as bigint) as funcs_matched, cast(sum(without_ast) as bigint) as without_ast from $results""")
def _(v):
    return _streamed(v).totals()


@query("stm01_streamed_binaries", """
with u as (select sha256('p' || cast(seq % 997 as string)) as sha, min_by(repo_owner, seq) as o, min_by(repo_name, seq) as n, max_by(funcs_matched > 0, seq) as s
    from $results where has_makefiles group by all)
select coalesce(b.sha, u.sha) as sha, case when b.sha is not null then b.repo_owner else u.o end as repo_owner,
    case when b.sha is not null then b.repo_name else u.n end as repo_name, coalesce(u.s, b.success) as success
from $binaries_before b full join u on b.sha = u.sha""")
def _(v):
    return _streamed(v).latest("binaries")


@query("stm01_streamed_matches", """
select coalesce(s.repo_owner, r.repo_owner) as repo_owner, coalesce(s.repo_name, r.repo_name) as repo_name,
    coalesce(r.num_makefiles, s.files_found) as files_found, coalesce(r.num_binaries, s.funcs_found) as funcs_found,
    coalesce(r.funcs_matched, s.funcs_matched) as funcs_matched, coalesce(r.without_ast, s.funcs_matched_without_ast) as funcs_matched_without_ast
from $match_func_before s full join (select * from $results where has_makefiles) r on s.repo_owner = r.repo_owner and s.repo_name = r.repo_name""")
def _(v):
    return _streamed(v).latest("matches")


@query("stm01_streamed_libraries", "select distinct 'l' || cast(num_makefiles as string) as library from $results where has_makefiles")
def _(v):
    return _streamed(v).libraries()


def _streamed(v):
    """Results that arrive in three parts, one run of the stream for each; their order decides which owner and outcome stays."""
    from corpusflow.streaming.results import ResultFold, start

    base = working_path(v.spark, "stream")
    made = F.col("has_makefiles")
    results = v("results").withColumns({
        "sha": F.when(made, F.sha2(F.concat(F.lit("p"), (F.col("seq") % 997).cast("string")), 256)), "success": F.col("funcs_matched") > 0,
        "files_found": F.when(made, F.col("num_makefiles")), "funcs_found": F.col("num_binaries"), "funcs_matched_without_ast": F.col("without_ast"),
        "library": F.when(made, F.concat(F.lit("l"), F.col("num_makefiles").cast("string"))),
    })
    last = results.agg(F.max("seq")).first()[0]
    fold = ResultFold(v.spark, base, v("repos_before"), v("binaries_before"), v("match_func_before"))
    for part in range(3):
        results.filter(F.floor(F.col("seq") * 3 / (last + 1)) == part).write.mode("append").parquet(f"{base}/in")
        source = v.spark.readStream.schema(results.schema).parquet(f"{base}/in")
        start(source, fold).awaitTermination()
    return fold
