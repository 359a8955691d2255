"""Joins between the list, state and binary tables, and library resolution."""

from pyspark.sql import functions as F

from corpusflow.catalog.registry import query
from corpusflow.catalog.state import _MAPPING
from corpusflow.functions import ccommand
from corpusflow.operators import joins, libraries, rollups
from corpusflow.operators.ordered import earliest
from corpusflow.operators.state import REPO_KEY
from corpusflow.plans import build_run, decompile_run

_NAMED = """(select idx, 'c' || cast(idx % 1000 as string) as repo_owner, 'r' || cast(idx as string) as repo_name from $repo_list where trim(line) <> '')"""


@query("jn01_requests", f"""
select w.idx, w.repo_owner, w.repo_name, s.repo_name is not null as known, s.clone_successful, s.compiled
from {_NAMED} w left join $repos_before s using (repo_owner, repo_name)""")
def _(v):
    joined = build_run.requests(v("repo_list"), v("repos_before"))
    return joined.select("idx", *REPO_KEY, "known", "clone_successful", "compiled")


@query("jn02_unprocessed_repos", """
select repo_owner, repo_name from $repos r where not exists (select 1 from $match_func_before m
    where m.repo_owner = r.repo_owner and m.repo_name = r.repo_name and m.funcs_matched_without_ast = 0)""")
def _(v):
    return joins.unprocessed(v("repos"), v("match_func_before")).select(*REPO_KEY)


@query("jn03_binary_actions", _MAPPING + """
select m.sha, case when b.sha is null then 'process' when b.repo_owner is null then 'migrate' else 'skip' end as action
from m left join $binaries_before b on b.sha = m.sha""")
def _(v):
    return decompile_run.binary_actions(rollups.binary_mapping(v("makefile_binary")), v("binaries_before")).select("sha", "action")


@query("jn03_pending_binaries", """
select distinct sha from $makefile_binary where sha not in (select sha from $binaries_before)""")
def _(v):
    return decompile_run.pending(v("makefile_binary"), v("binaries_before")).select("sha")


@query("jn04_decompiled_for_repo", """
select m.repo_owner, m.repo_name, m.directory, m.path, m.sha from $makefile_binary m where exists (select 1 from $binaries b
    where b.repo_owner = m.repo_owner and b.repo_name = m.repo_name and b.sha = m.sha and b.success)""")
def _(v):
    kept = joins.decompiled_for_repo(v("makefile_binary"), v("binaries"))
    return kept.select(*REPO_KEY, "directory", "path", "sha")


@query("win02_first_claims", """
select repo_owner, repo_name, sha, min_by(directory, makefile_pos * 100000000000 + binary_pos) as directory,
    min_by(path, makefile_pos * 100000000000 + binary_pos) as path from $makefile_binary group by all""")
def _(v):
    return joins.first_claims(v("makefile_binary")).select(*REPO_KEY, "sha", "directory", "path")


@query("win02_work_items", """
with c as (select repo_owner, repo_name, sha, min(makefile_pos * 100000000000 + binary_pos) as place, min_by(directory, makefile_pos * 100000000000 + binary_pos) as directory,
    min_by(path, makefile_pos * 100000000000 + binary_pos) as path
    from $makefile_binary m where exists (select 1 from $binaries b where b.repo_owner = m.repo_owner and b.repo_name = m.repo_name and b.sha = m.sha and b.success) group by all),
d as (select *, floor(place / 100000000000) as makefile_pos from c),
l as (select repo_owner, repo_name, directory, max(makefile_pos) as makefile_pos from d group by all)
select repo_owner, repo_name, directory, max_by(sha, place) as sha from d semi join l using (repo_owner, repo_name, directory, makefile_pos)
group by repo_owner, repo_name, directory, makefile_pos, path""")
def _(v):
    return joins.work_items(v("makefile_binary"), v("binaries")).select(*REPO_KEY, "sha", "directory")


@query("jn05_sources_with_output", """
select file_id, sha from $c_source where sha in (select sha from $decompiled)""")
def _(v):
    return joins.present_in(v("c_source"), v("decompiled"), ["sha"]).select("file_id", "sha")


@query("jn13_listed_products", """
with listed as (select repo_name, directory, path, max_by(sha, binary_pos) as sha from $makefile_binary where success group by all)
select m.repo_name, m.directory, m.path, l.sha, count(*) as n from $makefile_binary m join listed l using (repo_name, directory, path) group by all""")
def _(v):
    keys = ["repo_name", "directory", "path"]
    produced = v("makefile_binary").select(*keys)
    listed = v("makefile_binary").filter("success").select(*keys, "sha", "binary_pos")
    return joins.listed_products(produced, listed, keys, F.col("binary_pos")).groupBy(*keys, "sha").agg(F.count("*").alias("n"))


_RANKED = r"""
with l as (select lib, replace(replace(lib, '_', '[-_]'), '+', '\+') as n from $lib_req),
c as (select lib, n, pkg from l join $pkg p on regexp_matches(p.pkg, l.n)),
k as (select lib, pkg, 1 as priority, regexp_extract(pkg, 'lib' || n || '-dev') as m from c
    union all select lib, pkg, 2, regexp_extract(pkg, 'lib' || n || '(-?[0-9.]+)?-dev') from c
    union all select lib, pkg, 3, regexp_extract(pkg, 'lib' || n || '(-?[0-9.]+)?') from c
    union all select lib, pkg, 4, regexp_extract(pkg, n || '(-?[0-9.]+)?-dev') from c
    union all select lib, pkg, 5, regexp_extract(pkg, n) from c),
b as (select lib, priority, min({'o': cast(length(pkg) - length(m) as integer), 'p': pkg}) as b from k where m <> '' group by all)"""


@query("jn11_package_candidates", _RANKED + " select lib, priority, b.o as outside, b.p as pkg from b")
def _(v):
    return libraries.candidates(v("lib_req"), v("pkg"))


@query("win03_best_packages", _RANKED + """
select lib, min(priority) as priority, min_by(b.o, priority) as outside, min_by(b.p, priority) as pkg from b
where length(b.p) * 3 <= 50 group by lib""")
def _(v):
    installs = v("pkg").select("pkg", (F.length("pkg") * 3).alias("new_installs"))
    return libraries.best_packages(v("lib_req"), v("pkg"), installs)


@query("src06_library_words", """
select distinct l_returnflag || cast(l_suppkey as string) as library from lineitem""")
def _(v):
    from corpusflow.catalog.files import staged_text
    from corpusflow.sources import readers

    words = F.concat(F.lit("  "), "l_returnflag", F.col("l_suppkey").cast("string"), F.lit(" \t "))
    path = staged_text(v, "libraries", v("lineitem").select(words.alias("value")))
    return readers.library_log(v.spark, path)


@query("txt19_compile_commands", r"""
with a as (select repo_id, seq, cmd, 'src/f' || regexp_extract(cmd, 'src/f(\d+)\.c', 1) as stem, regexp_extract(cmd, '-l([A-Z]\d+)', 1) as lib,
    regexp_extract(cmd, '-o (\S+)', 1) as o, contains(cmd, '-l z') as z from $cc)
select repo_id, seq, cmd, lib || ' m' || case when z then ' z' else '' end as libs, stem || '.c' as sources,
    case when o <> '' then o else stem || '.o' end as object,
    'gcc -c ' || stem || '.c' || case when z then ' -DX=1' else '' end || ' -o ' || case when o <> '' then o else stem || '.o' end
    || ' -O0 -g -E -l' || lib || ' -lm' || case when z then ' -lz' else '' end as effective from a""")
def _(v):
    parsed = ccommand.parsed(v("cc"), override_flags="-E")
    lists = [F.array_join(c, " ").alias(c) for c in ("libs", "sources")]
    return parsed.select("repo_id", "seq", "cmd", *lists, "object", "effective")


@query("txt20_failed_libraries", r"""
select library, count(*) as n from (select regexp_extract(cmd, '-l([A-Z]\d+)', 1) as library from $cc where rc <> 0
    union all select 'm' from $cc where rc <> 0 union all select 'z' from $cc where rc <> 0 and contains(cmd, '-l z')
    union all select regexp_extract(cmd, 'cflags (\S+)', 1) from $pkg_config where rc <> 0 union all select 'glib-2.0' from $pkg_config where rc <> 0)
group by library""")
def _(v):
    mentions = ccommand.failed_libraries(v("cc"), []).union(ccommand.failed_packages(v("pkg_config"), []))
    return mentions.groupBy("library").agg(F.count("*").alias("n"))


@query("udf01_file_predicate", """
select l_orderkey, md5(cast(l_partkey as string)) as key from lineitem where l_partkey > 100 and l_comment_free
""".replace("l_comment_free", "l_returnflag <> 'N'"))
def _(v):
    files = v("lineitem").select("l_orderkey", F.col("l_returnflag").alias("directory"), F.col("l_partkey").cast("string").alias("path"))
    kept = joins.keep_files(
        files, lambda directory, path: (path.cast("bigint") > 100) & (directory != "N"), lambda directory, path: F.md5(path)
    )
    return kept.select("l_orderkey", F.col("sha").alias("key"))
