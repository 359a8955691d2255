"""Views over the given tables in the shape of the corpus tables.

Each view is one SQL text that reads the same in Spark and DuckDB; ``$name`` stands for a
table or another view. No view drops rows to make a check cheap: only the views named ``_before``, older states that
a query brings up to date, keep the rows before a date.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

_REPOS = """
select 'c' || cast(o_orderkey % 1000 as string) as repo_owner, 'r' || cast(o_orderkey as string) as repo_name,
    cast(floor(o_totalprice * 1000) as bigint) as repo_size, o_orderpriority <> '5-LOW' as clone_successful,
    o_orderstatus <> 'P' as compiled, o_orderkey % 8 as num_makefiles, o_custkey % 5 as num_binaries
from $orders"""
_BINARIES = """
select sha256('p' || cast(l_partkey as string)) as sha,
    case when l_partkey % 4 <> 0 then 'c' || cast(min(l_orderkey) % 1000 as string) end as repo_owner,
    case when l_partkey % 4 <> 0 then 'r' || cast(min(l_orderkey) as string) end as repo_name,
    l_partkey % 3 <> 0 as success
from $lineitem group by l_partkey"""
_MATCH_FUNC = """
select 'c' || cast(o_orderkey % 1000 as string) as repo_owner, 'r' || cast(o_orderkey as string) as repo_name,
    o_orderkey % 11 as files_found, o_orderkey % 97 + 20 as funcs_found, o_orderkey % 20 as funcs_matched,
    case when o_orderkey % 3 = 0 then 0 else o_orderkey % 4 end as funcs_matched_without_ast
from $orders"""
# A state as of a date, for queries that bring it up to date: later orders are not in it yet.
_ORDERED_BEFORE = " where o_orderdate < timestamp '1999-09-01 00:00:00'"

VIEWS: dict[str, str] = {
    # One line of a repository list per order; one in six lines is blank.
    "repo_list": """
select o_orderkey as idx, case o_orderkey % 6
    when 0 then 'https://host.example/c' || cast(o_orderkey % 1000 as string) || '/r' || cast(o_orderkey as string) || '.git'
    when 1 then '  c' || cast(o_orderkey % 1000 as string) || '/r' || cast(o_orderkey as string) || '//'
    when 2 then 'https://api.host.example/repos/c' || cast(o_orderkey % 1000 as string) || '/r' || cast(o_orderkey as string)
    when 3 then 'www.host.example/c' || cast(o_orderkey % 1000 as string) || '/r' || cast(o_orderkey as string) || '.git/ '
    when 4 then '   '
    else 'c' || cast(o_orderkey % 1000 as string) || '/r' || cast(o_orderkey as string) end as line
from $orders""",
    "makefile_binary": """
select 'c' || cast(l_orderkey % 1000 as string) as repo_owner, 'r' || cast(l_orderkey as string) as repo_name,
    '/usr/src/repo/d' || cast(l_linenumber as string) as directory, cast(l_linenumber as bigint) as makefile_pos,
    l_partkey * 100000 + l_suppkey as binary_pos,
    'obj/p' || cast(l_partkey as string) || '_s' || cast(l_suppkey as string) || '.o' as path,
    sha256('p' || cast(l_partkey as string)) as sha, (l_orderkey * 7 + l_linenumber * 3) % 5 <> 0 as success, l_shipdate as built
from $lineitem""",
    "repos": _REPOS,
    "repos_before": _REPOS + _ORDERED_BEFORE,
    # Outcome of processing each repository; null means that the stage did not run.
    "results": """
select o_orderkey as seq, 'c' || cast(o_orderkey % 1000 as string) as repo_owner, 'r' || cast(o_orderkey as string) as repo_name,
    case o_orderpriority when '1-URGENT' then null when '2-HIGH' then false else true end as clone_success,
    case o_orderpriority when '3-MEDIUM' then 0 when '4-NOT SPECIFIED' then cast(floor(o_totalprice) as bigint) end as repo_size,
    o_orderstatus <> 'O' as has_makefiles, o_custkey % 9 as num_makefiles, o_custkey % 4 as num_binaries,
    o_custkey % 3 as funcs_matched, o_custkey % 2 as without_ast
from $orders""",
    "binaries": _BINARIES,
    "binaries_before": _BINARIES + " having min(l_shipdate) < timestamp '1995-06-01 00:00:00'",
    "match_func": _MATCH_FUNC,
    "match_func_before": _MATCH_FUNC + _ORDERED_BEFORE,
    "compile_log": """
select event_id as line_no, ts, case
    when event_type = 'error' then cast(date_trunc('second', ts) as string) || ',123 WARNING: (Worker '
        || lpad(cast(user_id % 16 as string), 2, ' ') || ') No Makefiles found in u' || cast(user_id as string)
        || '/r-' || cast(user_id % 7 as string) || ', repository deleted'
    when event_type = 'signup' then 'noise ' || props
    else cast(date_trunc('second', ts) as string) || ',123 INFO: (Worker ' || lpad(cast(user_id % 16 as string), 2, ' ')
        || ') ' || cast(event_id % 5 as string) || ' (' || cast(event_id % 5 + 1 as string) || ') out of '
        || cast(event_id % 9 + 6 as string) || ' Makefile(s) in u' || cast(user_id as string) || '/r-'
        || cast(user_id % 7 as string) || ' compiled (partially), yielding ' || cast(event_id % 40 as string)
        || ' binaries' end as line
from $events""",
    "compile_log_plain": """
select line_no, replace(regexp_replace(line, '[(]Worker [ 0-9]+[)] ', ''), 'r-', 'r_') as line from $compile_log""",
    "compile_log_old": "select line_no, line from $compile_log where ts < timestamp '2024-01-02 00:00:00'",
    "compile_log_new": "select line_no, line from $compile_log where ts >= timestamp '2024-01-02 00:00:00'",
    "clone_log": """
select o_orderkey as id, case o_orderpriority when '1-URGENT' then '' when '2-HIGH' then 'remote: Repository not found.'
    when '3-MEDIUM' then 'fatal: unable to access'
    when '5-LOW' then 'fatal: could not read Username for ''https://github.com'': terminal prompts disabled'
    else '' end as output, o_orderpriority = '1-URGENT' as timed_out, o_orderpriority = '4-NOT SPECIFIED' as exited_ok,
    o_custkey % 13 = 0 as folder_exists, o_custkey % 7 = 0 as submodule_failed
from $orders""",
    "files": """
select l_orderkey as repo_id, 'd' || cast(l_linenumber as string) as dir, case l_partkey % 10 when 0 then 'Makefile'
    when 1 then 'makefile' when 2 then 'MAKEFILE' when 3 then 'configure.ac' when 4 then 'Configure.in'
    when 5 then '.gitmodules' when 6 then 'Makefile.am' when 7 then 'configure' when 8 then 'autogen.sh'
    else 'main.c' end as file, l_linenumber = 1 as is_root
from $lineitem""",
    "cc": """
select l_orderkey as repo_id, l_linenumber as seq, 'gcc -c -O2 -Wall -march=native src/f' || cast(l_partkey % 30 as string)
    || '.c -l' || l_returnflag || cast(l_suppkey as string) || ' -lm -ggdb3'
    || case when l_suppkey % 3 = 0 then ' -o out/f' || cast(l_partkey as string) || '.o' else '' end
    || case when l_suppkey % 4 = 0 then ' -l z -flto -DX=1' else '' end as cmd,
    case when l_linestatus = 'F' then 1 else 0 end as rc
from $lineitem""",
    "pkg_config": """
select l_orderkey as repo_id, 'pkg-config --cflags ' || lower(l_returnflag) || cast(l_suppkey as string) || ' glib-2.0' as cmd,
    case when l_linestatus = 'F' then 1 else 0 end as rc
from $lineitem""",
    "runs": """
select l_orderkey as repo_id, cast(l_linenumber as bigint) as pos, cast(sum(l_quantity) as bigint) as elapsed
from $lineitem group by l_orderkey, l_linenumber""",
    "decompiled": """
select sha256('p' || cast(l_partkey as string)) as sha, '_f' || cast(l_orderkey % 50 as string) as func_name,
    (l_orderkey * 10 + l_linenumber) * 100000 + l_suppkey as line_pos,
    'int f' || cast(l_orderkey % 50 as string) || '(int @@VAR_' || cast(l_linenumber as string) || '@@a1@@n'
    || cast(l_suppkey as string) || '@<rdi>) { @@VAR_9@@v2@@len' || cast(l_partkey as string) || ' = @@VAR_'
    || cast(l_linenumber as string) || '@@a1@@n' || cast(l_suppkey as string)
    || case when l_suppkey % 10 = 0 then '; @@VAR_9@@v2@@other' else '' end || '; }' as raw_code
from $lineitem""",
    "decompiled_line": """
select sha, line_pos, '{"function": "' || func_name || '", "raw_code": "' || raw_code || '", "ast": {"node_id": 0}'
    || case when line_pos % 17 = 0 then '' else '}' end as line
from $decompiled""",
    "c_source": """
select p_partkey as file_id, sha256('p' || cast(p_partkey as string)) as sha,
    'typedef int size_t;' || chr(10) || 'typedef int __end_of_fake_libc__;' || chr(10) || '# 1 "a.c"' || chr(10)
    || 'int f' || cast(p_partkey % 50 as string) || '(int a) { if (a) { a = ' || cast(p_size as string) || '; } return a; }' || chr(10)
    || '#pragma once' || chr(10) || 'static char *s = "' || p_name || ' } {";' || chr(10)
    || 'char * _f' || cast(p_partkey % 50 as string) || '(void) {' || chr(10) || '  return 0x1F; }' || chr(10)
    || 'static unsigned long *(*pick' || cast(p_size as string) || '(int k))(void) { while (k >= 0) { k--; } return 0; }' || chr(10)
    || case when p_size % 7 = 0 then 'int old(a) int a; { return a; }' || chr(10) else '' end as code
from $part""",
    "parse_error": """
select p_partkey as file_id, 'a.c:' || cast(p_size as string) || ':'
    || cast(case p_partkey % 3 when 0 then 14 + length(cast(p_size as string)) when 1 then 12 else 15 end as string)
    || ': before: bar' as message, case p_partkey % 3
    when 0 then 'unsigned t' || cast(p_size as string) || ' * bar;' when 1 then 'int g(int, bar b) ;'
    else 'no_type here( bar' end as code_line
from $part""",
    "tree": """
select o_orderkey as node_id, case when o_orderkey > 0 then cast(floor((o_orderkey - 1) / 2) as bigint) end as parent_id,
    case when o_custkey % 3 = 0 then o_custkey * 16 end as ea
from $orders""",
    "var_use": """
select l_suppkey as binary_id, l_orderkey % 200 as func_id, case l_linenumber when 1 then 'v1' when 2 then 'a2'
    else 'nm' || cast(l_linenumber as string) end as name, l_partkey as ea, l_orderkey * 8 + l_linenumber as visit
from $lineitem""",
    "ctree": """
select p_partkey as func_id, '{"node_id":0,"node_type":"block","address":"' || lpad(cast(p_partkey as string), 8, '0')
    || '","children":[{"node_id":1,"node_type":"asg","address":"FFFFFFFFFFFFFFFF","x":{"node_id":2,"node_type":"var","var_id":"0","old_name":"v1","new_name":"n'
    || cast(p_size as string) || '"},"y":{"node_id":3,"node_type":"num","name":"' || cast(p_size as string) || '"}}]}' as ast
from $part""",
    "c_ast": """
select p_partkey as func_id, '{"_t":"FuncDef","_p":' || cast(p_size as string) || ',"_c":{"decl":{"_t":"Decl","name":"f'
    || cast(p_partkey as string) || '","_p":' || cast(p_size + 1 as string) || ',"_c":{"type":null}},"body":{"_t":"Compound","_p":'
    || cast(p_size + 5 as string) || ',"_c":{"block_items":[{"_t":"Return","_p":null,"_c":{"expr":{"_t":"ID","name":"a","_p":'
    || cast(p_size + 7 as string) || ',"_c":{}}}},{"_t":"EmptyStatement","_p":' || cast(p_size + 9 as string)
    || ',"_c":{}}]}},"param_decls":null}}' as ast
from $part""",
    "pkg": """
select distinct case p_partkey % 6 when 0 then 'lib' || replace(p_name, ' ', '-') || '-dev'
    when 1 then 'lib' || replace(p_name, ' ', '-') || cast(p_size as string) || '-dev'
    when 2 then 'lib' || replace(p_name, ' ', '_') || '-' || cast(p_size as string) || '.1'
    when 3 then replace(p_name, ' ', '-') || '-' || cast(p_size as string) || '-dev'
    when 4 then 'x' || replace(p_name, ' ', '+') || lower(p_type)
    else 'lib' || replace(p_name, ' ', '-') || lower(p_type) || cast(p_size as string) end as pkg
from $part""",
    "lib_req": """
select distinct case p_partkey % 5 when 0 then replace(p_name, ' ', '_') when 1 then replace(p_name, ' ', '-')
    when 2 then replace(p_name, ' ', '.') || lower(p_type) when 3 then replace(p_name, ' ', '+')
    else replace(p_name, ' ', '_') || cast(p_size as string) end as lib
from $part""",
    # Documents as repositories: a line is a Makefile, its words are the paths of the binaries; the last hash is missing
    # in Makefiles of more than three binaries.
    "nested_makefile": """
select source as repo_owner, 'd' || cast(doc_id as string) as repo_name, lang, text from $documents""",
}

_NAME = re.compile(r"\$([a-z_]+)")


def _prefix(sf_dir: str) -> str:
    return f"cf_{zlib.crc32(sf_dir.encode()):08x}_"


def _for_spark(sql: str, prefix: str) -> str:
    sql = re.sub(r"sha256\(('p' \|\| cast\([a-z_]+ as string\))\)", r"sha2(\1, 256)", sql)
    return _NAME.sub(lambda m: prefix + m.group(1), sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame; its inputs are registered as temporary views of this folder."""
    prefix = _prefix(sf_dir)
    if name in TABLES:
        frame = table(spark, sf_dir, name)
    else:
        for needed in _NAME.findall(VIEWS[name]):
            view(spark, sf_dir, needed).createOrReplaceTempView(prefix + needed)
        frame = spark.sql(_for_spark(VIEWS[name], prefix))
    return frame


def with_views(sql: str) -> str:
    """The DuckDB form: the views that the text names are put before it as common table expressions."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                ordered.append(name)

    visit(sql)
    plain = lambda text: _NAME.sub(lambda m: m.group(1), text)
    parts = [f"{name} as ({plain(VIEWS[name])})" for name in ordered]
    body = plain(sql).strip()
    if not parts:
        return body
    if body.lower().startswith("with recursive "):
        return "with recursive " + ",\n".join(parts) + ",\n" + body[len("with recursive "):]
    if body.lower().startswith("with "):
        return "with " + ",\n".join(parts) + ",\n" + body[len("with "):]
    return "with " + ",\n".join(parts) + "\n" + body
