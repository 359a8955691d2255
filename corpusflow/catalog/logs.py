"""Build-run logs."""

from pyspark.sql import functions as F

from corpusflow.catalog.registry import query
from corpusflow.functions import loglines
from corpusflow.operators import logs

FULL, PLAIN, NONE = loglines.SUMMARY, loglines.SUMMARY_PLAIN, loglines.NO_MAKEFILES


def _fields(pattern, fields):
    return ", ".join(
        f"cast(regexp_extract(line, '{pattern}', {i + 1}) as bigint) as {f}" if f.startswith("n_")
        else f"regexp_extract(line, '{pattern}', {i + 1}) as {f}" for i, f in enumerate(fields)
    )


def parsed(view, pattern, fields):
    return f"select line_no, {_fields(pattern, fields)} from ${view} where regexp_matches(line, '{pattern}')"


def snap(view):
    return f"""(select owner || '/' || name as repo, max_by(n_success, line_no) as n_success, max_by(n_total, line_no) as n_total from (
    select line_no, owner, name, n_success, n_total from ({parsed(view, FULL, loglines.SUMMARY_FIELDS)}) union all
    select line_no, owner, name, 0, 0 from ({parsed(view, NONE, loglines.NO_MAKEFILES_FIELDS)})) group by 1)"""


@query("src07_log_lines", "select line_no - (select min(line_no) from $compile_log) as line_no, line from $compile_log")
def _(v):
    from corpusflow.catalog.files import staged_text
    from corpusflow.sources.readers import lines

    log = v("compile_log").select("line_no", "line")
    path = staged_text(v, "log", log.repartitionByRange("line_no").sortWithinPartitions("line_no").select("line"))
    return lines(v.spark, path).select(F.col("idx").alias("line_no"), F.col("value").alias("line"))


@query("txt01_summaries", parsed("compile_log", FULL, loglines.SUMMARY_FIELDS))
def _(v):
    return loglines.summaries(v("compile_log"))


@query("txt02_plain_summaries", parsed("compile_log_plain", PLAIN, loglines.SUMMARY_FIELDS))
def _(v):
    return loglines.plain_summaries(v("compile_log_plain"))


@query("txt03_no_makefiles", parsed("compile_log", NONE, loglines.NO_MAKEFILES_FIELDS))
def _(v):
    return loglines.without_makefiles(v("compile_log"))


@query("agg16_log_snapshot", f"select * from {snap('compile_log')}")
def _(v):
    return logs.snapshot(v("compile_log"))


_DIFF = f"""with c as (select repo, o.n_success as old_n_success, n.n_success as new_n_success, o.n_total as old_n_total, n.n_total as new_n_total
from {snap('compile_log_old')} o join {snap('compile_log_new')} n using (repo))"""


@query("jn08_run_comparison", _DIFF + """
select *, concat_ws(', ', case when old_n_success <> new_n_success then printf('n_success %d->%d', old_n_success, new_n_success) end,
    case when old_n_total <> new_n_total then printf('n_total %d->%d', old_n_total, new_n_total) end) as message
from c where old_n_success <> new_n_success or old_n_total <> new_n_total""")
def _(v):
    return logs.compare(logs.snapshot(v("compile_log_old")), logs.snapshot(v("compile_log_new")))


@query("jn08_decreases", _DIFF + """
select repo, 'n_success' as tag, old_n_success as old, new_n_success as new from c where old_n_success > new_n_success union all
select repo, 'n_total', old_n_total, new_n_total from c where old_n_total > new_n_total""")
def _(v):
    return logs.decreases(logs.compare(logs.snapshot(v("compile_log_old")), logs.snapshot(v("compile_log_new"))))


_VALUES = f"(select *, owner || '/' || name as repo from ({parsed('compile_log_plain', PLAIN, loglines.SUMMARY_FIELDS)}))"


@query("agg14_log_series", f"""
select repo, line_no, ts, n_partial, n_binaries, n_total, row_number() over (partition by repo order by line_no) - 1 as pos from {_VALUES}""")
def _(v):
    return logs.series(v("compile_log_plain"))


@query("agg15_changed_repos", f"""
select repo from {_VALUES} group by repo having min(n_partial) <> max(n_partial) or min(n_binaries) <> max(n_binaries) or min(n_total) <> max(n_total)""")
def _(v):
    return logs.changed_repos(v("compile_log_plain"))


_FAILING = f"""(select repo, max_by(n_partial, line_no) as n_partial, max_by(n_total, line_no) as n_total from {_VALUES}
    group by repo having max_by(n_partial, line_no) < max_by(n_total, line_no))"""


@query("win07_failing_repos", f"select * from {_FAILING}")
def _(v):
    return logs.failing_repos(v("compile_log_plain"))


@query("win06_sampled_repos", f"""
select * from (select * from {_FAILING} order by md5('19:' || repo), repo limit 100) where n_total <= 50""")
def _(v):
    return logs.sample_failing(logs.failing_repos(v("compile_log_plain")), 100, 19)


# Clones have the directories of the recorded Makefiles and one without any record; a directory is the root of the repository at times.
_PLACE = "case when l_linenumber = 1 then '' else '/d' || cast(l_linenumber as string) end"


@query("jn09_makefile_report", f"""
with sample as (select repo from (select * from {_FAILING} order by md5('19:' || repo), repo limit 100) where n_total <= 50),
l as (select 'u' || cast(l_orderkey % 500 as string) || '/r_' || cast(l_orderkey % 500 % 7 as string) as repo, {_PLACE} as place, l_returnflag from lineitem),
d as (select distinct repo, repo || place as dir from l), r as (select distinct repo, repo || place as dir from l where l_returnflag <> 'N')
select d.repo, d.dir, case when r.dir is null then 'Failed' else '' end as status from d left join r using (repo, dir) where d.repo in (from sample)""")
def _(v):
    sampled = logs.sample_failing(logs.failing_repos(v("compile_log_plain")), 100, 19)
    owner, name = F.expr("'u' || cast(l_orderkey % 500 as string)"), F.expr("'r_' || cast(l_orderkey % 500 % 7 as string)")
    rows = v("lineitem").select(owner.alias("repo_owner"), name.alias("repo_name"), F.expr(_PLACE).alias("place"), "l_returnflag")
    repo = F.concat_ws("/", "repo_owner", "repo_name")
    found = rows.select(repo.alias("repo"), F.concat(F.lit("test_compile/"), repo, "place").alias("path")).distinct()
    states = rows.filter("l_returnflag <> 'N'").select("repo_owner", "repo_name", F.concat(F.lit("/usr/src/repo"), "place").alias("directory"))
    return logs.sampled_report(sampled, found, states)
