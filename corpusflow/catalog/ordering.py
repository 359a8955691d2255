"""Ordering, batches, budgets and progress."""

from pyspark.sql import functions as F

from corpusflow.catalog.registry import query
from corpusflow.operators import ordered
from corpusflow.operators.state import REPO_KEY
from corpusflow.plans import build_run


@query("win01_time_budget", """
select repo_id, pos, elapsed from (select *, coalesce(sum(elapsed) over (partition by repo_id order by pos rows between unbounded preceding and 1 preceding), 0) as used
    from $runs) where used < 60""")
def _(v):
    return build_run.within_budget(v("runs"), ["repo_id"], 60)


@query("ord01_first_repos", """
select idx, 'c' || cast(idx % 1000 as string) as repo_owner, 'r' || cast(idx as string) as repo_name from $repo_list where trim(line) <> '' order by idx limit 100""")
def _(v):
    return build_run.first_repos(v("repo_list"), 100).select("idx", *REPO_KEY)


@query("ord01_first_pending", """
select row_number() over (order by n) - 1 as index, repo_owner, repo_name from (select cast(substr(repo_name, 2) as bigint) as n, * from $repos
    where clone_successful and compiled and num_makefiles <> 0 and num_binaries <> 0 order by n limit 100)""")
def _(v):
    from corpusflow.functions.outcomes import eligible

    wanted = eligible(F.col("clone_successful"), F.col("compiled"), F.col("num_makefiles"), F.col("num_binaries"))
    repos = v("repos").filter(wanted).withColumn("n", F.substr("repo_name", F.lit(2)).cast("bigint"))
    return build_run.first_pending(repos, "n", 100).select("index", *REPO_KEY)


@query("ord02_stable_batches", """
select repo_owner, repo_name, row_number() over (order by repo_owner, repo_name) - 1 as idx,
    cast(floor((row_number() over (order by repo_owner, repo_name) - 1) / 1000) as bigint) as batch from $repos""")
def _(v):
    return ordered.batches(v("repos"), REPO_KEY, 1000).select(*REPO_KEY, "idx", "batch")


@query("ord03_running_totals", """
with b as (select cast(floor(seq / 100) as bigint) as block, count(*) as results, sum(funcs_matched) as m, sum(without_ast) as w from $results group by 1)
select block, cast(sum(results) over (order by block) as bigint) as results, cast(sum(m) over (order by block) as bigint) as funcs_matched,
    cast(sum(w) over (order by block) as bigint) as without_ast from b""")
def _(v):
    sums = {"funcs_matched": F.col("funcs_matched"), "without_ast": F.col("without_ast")}
    return ordered.progress(v("results"), "seq", 100, sums)
