"""C source text, tokens, decompiled code and matching."""

from pyspark.sql import functions as F

from corpusflow.catalog.registry import query
from corpusflow.functions import ccode
from corpusflow.functions.rows import with_once
from corpusflow.operators import matching, state, tokens
from corpusflow.plans import match_run
from corpusflow.session import settle

RE = ccode.token_pattern(own="").replace("'", "''")
_VAR = ccode.VARIABLE


def _plain(code):
    return f"list_filter(regexp_extract_all({code}, '{RE}'), lambda x: not regexp_matches(x, '^[ \\t\\n\\r\\f]'))"


_SOURCE = r"(select file_id, sha, regexp_replace(code, '(?m)^#[^\n]*\n', '', 'g') as code from $c_source)"

# Token table with offsets, lines and columns by windows over the tiling matches.
TOKENS = rf"""
p as (select file_id, i, value from {_SOURCE} s, unnest(regexp_extract_all(code, '{RE}')) with ordinality u(value, i)),
o as (select *, coalesce(sum(length(value)) over w, 0) as offs, length(value) - length(replace(value, chr(10), '')) as nl,
    regexp_matches(value, '^[ \t\n\r\f]') as space from p window w as (partition by file_id order by i rows between unbounded preceding and 1 preceding)),
o2 as (select *, case when nl > 0 then offs + length(value) - length(regexp_extract(value, '[^\n]*$')) - 1 end as nl_at from o),
t as (select file_id, cast(coalesce(sum(case when space then 0 else 1 end) over w, 0) as bigint) as pos, value, space, cast(coalesce(sum(nl) over w, 0) + 1 as bigint) as line,
    cast(offs - coalesce(max(nl_at) over w, -1) as bigint) as col, cast(offs as bigint) as offs
    from o2 window w as (partition by file_id order by i rows between unbounded preceding and 1 preceding)),
tok as (select file_id, pos, value, line, col, offs from t where not space)"""

_KEYWORDS = "(" + ", ".join(f"'{k}'" for k in ccode.KEYWORDS) + ")"
_SPECIFIERS = "(" + ", ".join(f"'{k}'" for k in ccode.SPECIFIERS) + ")"

FUNCTIONS = TOKENS + rf""",
d as (select *, coalesce(sum(case value when '{{' then 1 when '}}' then -1 else 0 end) over (partition by file_id order by pos rows between unbounded preceding and 1 preceding), 0) as depth,
    lag(value) over (partition by file_id order by pos) as b1, lead(value) over (partition by file_id order by pos) as a1,
    lead(value, 2) over (partition by file_id order by pos) as a2 from tok),
e as (select *, coalesce(sum(case when (depth <= 0 and value = ';') or (depth = 1 and value = '}}') then 1 else 0 end) over (partition by file_id order by pos
    rows between unbounded preceding and 1 preceding), 0) as item from d),
f as (select *, depth = 0 and value = '{{' as opens, depth = 0 and regexp_matches(value, '^[A-Za-z_$][A-Za-z_$0-9]*$') and value not in {_KEYWORDS}
    and a1 = '(' and coalesce(a2, '') <> '*' as named from e),
g as (select file_id, item, min(pos) as first, max(pos) as last, min(pos) filter (where opens) as body, arg_min(b1, pos) filter (where opens) as bb,
    arg_min(value, pos) filter (where named) as func_name, min(pos) filter (where depth = 0 and value not in {_SPECIFIERS}) as tp,
    min(pos) filter (where depth = 0 and pos > 0 and (named or value = '*')) as dp, arg_max(value, pos) as closing from f group by all),
h as (select *, case when tp > 0 then tp else dp end as lft from g where body is not null and closing = '}}'),
fn as (select file_id, func_name, arg_max(first, item) as first, arg_max(last, item) as last, arg_max(body, item) as body, arg_max(lft, item) as lft from h
    where bb = ')' and func_name is not null and body > first group by all)"""


@query("txt04_function_names", r"""
select sha, line_pos, regexp_extract(line, '"function":\s*"([^"]+)"', 1) as func_name from $decompiled_line""")
def _(v):
    return matching.named_lines(v("decompiled_line")).select("sha", "line_pos", "func_name")


def _decompiled(v):
    return v("decompiled").select("sha", "func_name", "line_pos", "raw_code")


_TRIPLES = rf"""
m as (select sha, line_pos, list_distinct(regexp_extract_all(raw_code, '{_VAR}')) as ms from $decompiled),
x as (select sha, line_pos, ms, len(list_distinct(list_transform(ms, lambda a: regexp_extract(a, '{_VAR}', 1)))) < len(ms) as conflict from m)"""


@query("txt05_variables", f"""
with {_TRIPLES}
select sha, line_pos, regexp_extract(a, '{_VAR}', 1) as id, regexp_extract(a, '{_VAR}', 2) as decompiled, regexp_extract(a, '{_VAR}', 3) as original
from (select sha, line_pos, unnest(ms) as a from x where not conflict)""")
def _(v):
    return matching.variable_rows(_decompiled(v)).drop("func_name")


@query("txt05_conflicting_functions", f"with {_TRIPLES} select sha, line_pos, 'conflicting_names' as reason from x where conflict")
def _(v):
    return matching.cleaned_functions(_decompiled(v))[1].select("sha", "line_pos", "reason")


_PREFIX = "(select *, 'v' || substr(translate(md5(raw_code), '0123456789abcdef', 'ghijklmnopqrstuv'), 1, 3) as prefix from $decompiled)"


@query("txt06_plain_variables", rf"""
select sha, line_pos, prefix, replace(regexp_replace(raw_code, '{_VAR}', '~~_\1', 'g'), '~~', prefix) as code from {_PREFIX}""")
def _(v):
    rows = with_once(_decompiled(v), prefix=ccode.safe_prefix(F.col("raw_code")))
    return rows.select("sha", "line_pos", "prefix", ccode.with_plain_variables(F.col("raw_code"), F.col("prefix")).alias("code"))


@query("txt07_without_registers", "select sha, line_pos, regexp_replace(raw_code, '@<[a-z0-9]+>', '', 'g') as code from $decompiled")
def _(v):
    return _decompiled(v).select("sha", "line_pos", ccode.without_registers(F.col("raw_code")).alias("code"))


@query("txt08_full_names", """
select sha, line_pos, replace(raw_code, 'int ' || substr(func_name, 2) || '(', 'int ' || func_name || '(') as code from $decompiled""")
def _(v):
    return matching.full_names(_decompiled(v)).select("sha", "line_pos", "code")


@query("txt09_without_line_controls", r"""
select file_id, regexp_replace(code, '(?m)^#[^\n]*\n', '', 'g') as chomped, regexp_replace(code, '(?m)^#[^\n]*$', '', 'g') as kept from $c_source""")
def _(v):
    code = F.col("code")
    return v("c_source").select(
        "file_id", ccode.without_line_controls(code).alias("chomped"), ccode.without_line_controls(code, True).alias("kept")
    )


@query("txt10_without_header", "select file_id, split_part(code, 'typedef int __end_of_fake_libc__;', -1) as code from $c_source")
def _(v):
    return v("c_source").select("file_id", ccode.without_header(F.col("code")).alias("code"))


_DIALECT = """'__int64 __fastcall g' || cast(p_size as string) || '(__int128 a, char *__restrict s) __attribute__((format(printf, 1, 2))) { __int8 b = "__int64 x"; __asm__ volatile("nop"); return (_QWORD)a__int64; }'"""


@query("txt11_plain_dialect", """
select p_partkey, 'long long  g' || cast(p_size as string) || '(long long a, char *restrict s)  { char b = "__int64 x"; __asm__ ; return (_QWORD)a__int64; }' as code from part""")
def _(v):
    return v("part").select("p_partkey", ccode.normalised(F.expr(_DIALECT)).alias("code"))


_VARIED = """concat(elt(p_partkey % 4 + 1, '__int64 ', 'unsigned __int8 *', '_QWORD ', '__const char *'), elt(p_size % 3 + 1, '__fastcall ', '', '__cdecl '), 'f', p_size,
    '(__int32 a', p_partkey, ', const __int16 *b) ', repeat('__attribute__ ((section(', p_size % 3), repeat('x)) ) ', p_size % 3), '{ ', case when p_partkey % 5 = 0
    then concat('__asm__ volatile ( "int ) $', p_size, '" ', repeat('(', p_size + 40), repeat(')', p_size + 40), ') ; ') else '' end, 'a', p_partkey, '__int64 = "', p_name, ' __int64"; }')"""


@query("txt11_varied_dialect", """
select p_partkey, case p_partkey % 4 when 0 then 'long long ' when 1 then 'unsigned char *' when 2 then '_QWORD ' else 'const char *' end
    || case when p_size % 3 = 1 then '' else ' ' end || 'f' || cast(p_size as string) || '(int a' || cast(p_partkey as string) || ', const short *b) ' || case when p_size % 3 > 0 then ' ' else '' end
    || '{ ' || case when p_partkey % 5 = 0 then '__asm__  ; ' else '' end || 'a' || cast(p_partkey as string) || '__int64 = "' || p_name || ' __int64"; }' as code from part""")
def _(v):
    return v("part").select("p_partkey", ccode.normalised(F.expr(_VARIED)).alias("code"))


def _files(v):
    return v("c_source").select("file_id", ccode.without_line_controls(F.col("code")).alias("code"))


def _tokens(v):
    return tokens.tokens(_files(v), "file_id")


def _items(v):
    return tokens.top_level_items(_files(v), "file_id")


@query("txt14_token_values", f"with {TOKENS} select file_id, pos, value, offs as \"offset\" from tok")
def _(v):
    return _tokens(v).select("file_id", "pos", "value", "offset")


@query("txt14_document_tokens", f"""
select value, count(*) as n from (select unnest({_plain('text')}) as value from documents) group by value""")
def _(v):
    values = v("documents").select(F.explode(ccode.token_values(F.col("text"))).alias("value"))
    return values.groupBy("value").agg(F.count("*").alias("n"))


@query("txt15_token_lines", f"with {TOKENS} select file_id, pos, value, line, col from tok")
def _(v):
    return _tokens(v).select("file_id", "pos", "value", "line", "col")


@query("txt16_functions", f"with {FUNCTIONS} select file_id, func_name, first, last, body from fn")
def _(v):
    return tokens.functions(_items(v), "file_id").select("file_id", "func_name", "first", "last", "body")


@query("txt16_rejected_items", f"with {FUNCTIONS} select file_id, body from h where body = first or (bb = ')' and func_name is null)")
def _(v):
    return tokens.rejected_items(_items(v), "file_id").select("file_id", "body")


@query("txt17_function_tokens", f"""
with {FUNCTIONS}
select file_id, func_name, lft as "left", string_agg(value, ' ' order by pos) as tokens from fn join tok using (file_id) where pos between lft and last group by all""")
def _(v):
    found = tokens.functions(_items(v), "file_id")
    return found.select("file_id", "func_name", "left", F.array_join("tokens", " ").alias("tokens"))


@query("win04_matching_braces", f"""
with {FUNCTIONS}
select fn.file_id, fn.body as start, fn.last as "right" from fn""")
def _(v):
    found = tokens.functions(_items(v), "file_id")
    return tokens.matching_brace(_tokens(v), found.select("file_id", F.col("body").alias("start")), "file_id")


@query("jn10_token_positions", f"""
with {TOKENS},
q as (select p_partkey as file_id, l_orderkey as probe, cast(l_linenumber as bigint) as line, l_suppkey as col from part join lineitem on p_partkey = l_partkey),
q2 as (select file_id, probe, line - 1 as line, col from q)
select distinct q2.file_id, q2.probe, q2.line, q2.col, case when q2.line > 0 then tok.pos end as token_pos
from q2 asof left join tok on q2.file_id = tok.file_id and q2.line * 1048576 + q2.col >= tok.line * 1048576 + tok.col""")
def _(v):
    probes = v("lineitem").select(
        F.col("l_partkey").alias("file_id"), F.col("l_orderkey").alias("probe"), (F.col("l_linenumber") - 1).alias("line"),
        F.col("l_suppkey").alias("col"),
    ).distinct()
    return tokens.token_at(_tokens(v), probes, "file_id", "probe")


_NEW_CODE = "'int ' || func_name || '(void) { return ' || cast(file_id as string) || '; }'"


def _spliced(v):
    files = _files(v)
    found = settle(tokens.functions(tokens.top_level_items(files, "file_id"), "file_id").drop("tokens"))
    new = found.filter("func_name not like 'pick%'").select("file_id", "func_name", F.expr(_NEW_CODE).alias("replacement"))
    return tokens.spliced(files, found, new, "file_id")


@query("txt12_spliced_files", rf"""
with s as {_SOURCE},
a as (select file_id, code, 'f' || cast(file_id % 50 as string) as fa from s),
m as (select *, regexp_replace(code, 'int f\d+\(int a\) [^\n]*', chr(10) || 'typedef int __func__' || fa || '__begin;' || chr(10) || 'int ' || fa || '(void) {{ return '
    || cast(file_id as string) || '; }}' || chr(10) || 'typedef int __func__' || fa || '__end;' || chr(10)) as c1 from a)
select file_id, regexp_replace(c1, 'char \* _f\d+\(void\) [^\n]*\n[^\n]*', chr(10) || 'typedef int __func___' || fa || '__begin;' || chr(10) || 'int _' || fa || '(void) {{ return '
    || cast(file_id as string) || '; }}' || chr(10) || 'typedef int __func___' || fa || '__end;' || chr(10)) as code from m""")
def _(v):
    return _spliced(v)


@query("txt13_marked_functions", """
select p_partkey as file_id, n.func_name as name, 'int ' || n.func_name || '(void) { return ' || cast(p_partkey as string) || '; }' as text
from part, (values ('f'), ('_f')) v(p), lateral (select v.p || cast(p_partkey % 50 as string) as func_name) n""")
def _(v):
    return _spliced(v).select("file_id", F.inline(ccode.marked_functions(F.col("code"))))


@query("txt18_undefined_types", """
select file_id, case p_partkey % 3 when 0 then 't' || cast(p_size as string) when 1 then 'bar' else 'here' end as type_name
from (select p_partkey as file_id, p_partkey, p_size from part)""")
def _(v):
    found = ccode.error_type(F.col("message"), F.col("code_line"))
    return v("parse_error").select("file_id", found.alias("type_name"))


@query("txt18_type_counts", """
select case p_partkey % 3 when 0 then 't' || cast(p_size as string) when 1 then 'bar' else 'here' end as type_name, count(*) as n from part group by all""")
def _(v):
    found = v("parse_error").select(ccode.error_type(F.col("message"), F.col("code_line")).alias("type_name"))
    return found.filter("type_name is not null").groupBy("type_name").agg(F.count("*").alias("n"))


@query("js01_decoded_lines", "select d.sha, d.line_pos, d.func_name, d.raw_code from $decompiled d where d.line_pos % 17 <> 0")
def _(v):
    good, _bad = matching.decoded_lines(matching.named_lines(v("decompiled_line")))
    return good.select("sha", "line_pos", "func_name", "raw_code")


@query("js01_rejected_lines", "select sha, line_pos from $decompiled where line_pos % 17 = 0")
def _(v):
    return matching.decoded_lines(matching.named_lines(v("decompiled_line")))[1].select("sha", "line_pos")


@query("jn06_lines_of_known_functions", f"""
with {FUNCTIONS}
select d.sha, d.func_name, d.line_pos from $decompiled d where (d.sha, d.func_name) in (select s.sha, fn.func_name from fn join $c_source s using (file_id))""")
def _(v):
    sources = v("c_source")
    known = settle(match_run.original_functions(match_run.distinct_sources(sources)).select("sha", "func_name"))
    lines = matching.lines_of_known_functions(matching.named_lines(v("decompiled_line")), known)
    return lines.select("sha", "func_name", "line_pos")


_MATCH = rf"""
with {FUNCTIONS},
org as (select s.sha, fn.func_name, string_agg(value, ' ' order by pos) as original_tokens from fn join tok using (file_id) join $c_source s using (file_id)
    where pos between lft and fn.last group by all),
good as (select * from {_PREFIX} where line_pos % 17 <> 0 and not (raw_code like '%@@other%')),
lst as (select sha, func_name, arg_max(raw_code, line_pos) as raw_code, arg_max(prefix, line_pos) as prefix from good group by all),
cl as (select sha, func_name, replace(replace(regexp_replace(regexp_replace(raw_code, '{_VAR}', '~~_\1', 'g'), '@<[a-z0-9]+>', '', 'g'), '~~', prefix),
    'int ' || substr(func_name, 2) || '(', 'int ' || func_name || '(') as code from lst)"""


@query("jn07_matched_functions", _MATCH + f"""
select sha, func_name, original_tokens, array_to_string({_plain('code')}, ' ') as decompiled_tokens from org join cl using (sha, func_name)""")
def _(v):
    found = match_run.matched_functions(v("c_source"), v("decompiled_line"))
    return found.select(
        "sha", "func_name", F.array_join("original_tokens", " ").alias("original_tokens"),
        F.array_join("decompiled_tokens", " ").alias("decompiled_tokens"),
    )


# The whole run in SQL: claimed files, original and decompiled functions, their records and the counts per repository.
RUN = _MATCH + rf""",
c as (select repo_owner, repo_name, sha, min(makefile_pos * 100000000000 + binary_pos) as place, min_by(directory, makefile_pos * 100000000000 + binary_pos) as directory,
    min_by(path, makefile_pos * 100000000000 + binary_pos) as path
    from $makefile_binary m where exists (select 1 from $binaries b where b.repo_owner = m.repo_owner and b.repo_name = m.repo_name and b.sha = m.sha and b.success) group by all),
md as (select *, floor(place / 100000000000) as makefile_pos from c),
lm as (select repo_owner, repo_name, directory, max(makefile_pos) as makefile_pos from md group by all),
items as (select repo_owner, repo_name, repo_owner || '/' || repo_name || '/' || replace(directory, '/usr/src/repo/', '') || '/' || path as file_path, max_by(sha, place) as sha
    from md semi join lm using (repo_owner, repo_name, directory, makefile_pos) group by repo_owner, repo_name, directory, makefile_pos, path),
rec as (select repo_owner, repo_name, file_path, sha, func_name, original_tokens, array_to_string({_plain('code')}, ' ') as decompiled_tokens,
    array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(raw_code, '{_VAR}'),
        lambda x: substr(split_part(x, '@@', 2), 5) || ':' || split_part(x, '@@', 3) || ':' || split_part(x, '@@', 4)))), ',') as variables,
    '{{"node_id":0}}' as tree from items join org using (sha) join cl using (sha, func_name) join lst using (sha, func_name)),
sums as (select repo_owner, repo_name, count(*) as total_files, count(*) filter (where i.sha in (select sha from $c_source) and i.sha in (select sha from $decompiled)) as files_found
    from items i group by all),
funs as (select repo_owner, repo_name, count(*) as funcs_found, count(*) filter (where (i.sha, o.func_name) in (select sha, func_name from cl)) as funcs_matched
    from items i join org o using (sha) where i.sha in (select sha from $decompiled) group by all),
tot as (select repo_owner, repo_name, total_files, files_found, coalesce(funcs_found, 0) as funcs_found, coalesce(funcs_matched, 0) as funcs_matched,
    cast(0 as bigint) as funcs_matched_without_ast from sums left join funs using (repo_owner, repo_name))"""


def match_run_of(v):
    return match_run.match_repositories(v("makefile_binary"), v("binaries"), v("c_source"), v("decompiled_line"))


RECORD_FIELDS = (
    "file_path string, binary_hash string, func_name string, variable_names map<string, struct<decompiled: string, original: string>>, "
    "original_tokens array<string>, decompiled_tokens array<string>, original_ast_json string, decompiled_ast_json string"
)


def record_columns(record):
    """The fields of a record in the form of the SQL text."""
    names = F.transform(F.map_entries(record["variable_names"]), lambda e: F.concat_ws(
        ":", F.substring_index(e["key"], "_", -1), e["value"]["decompiled"], e["value"]["original"]
    ))
    return [
        record["file_path"].alias("file_path"), record["binary_hash"].alias("sha"), record["func_name"].alias("func_name"),
        F.array_join(record["original_tokens"], " ").alias("original_tokens"), F.array_join(record["decompiled_tokens"], " ").alias("decompiled_tokens"),
        F.array_join(F.array_sort(names), ",").alias("variables"), record["decompiled_ast_json"].alias("tree"),
    ]


@query("js06_match_records", RUN + " select * from rec")
def _(v):
    rows = match_run_of(v)[0].select("repo_owner", "repo_name", F.from_json("record", RECORD_FIELDS).alias("r"))
    return rows.select("repo_owner", "repo_name", *record_columns(F.col("r")))


@query("agg11_match_summary", RUN + " select * from tot")
def _(v):
    return match_run_of(v)[1]


@query("ups04_after_match_run", RUN + """
select coalesce(s.repo_owner, t.repo_owner) as repo_owner, coalesce(s.repo_name, t.repo_name) as repo_name, coalesce(t.files_found, s.files_found) as files_found,
    coalesce(t.funcs_found, s.funcs_found) as funcs_found, coalesce(t.funcs_matched, s.funcs_matched) as funcs_matched,
    coalesce(t.funcs_matched_without_ast, s.funcs_matched_without_ast) as funcs_matched_without_ast
from $match_func_before s full join tot t on s.repo_owner = t.repo_owner and s.repo_name = t.repo_name""")
def _(v):
    return state.add_match_results(v("match_func_before"), match_run_of(v)[1].withColumn("seq", F.lit(0)))


_TYPED = """concat('typedef struct s', p_size, ' { int a; } t', p_size, ';\n', elt(p_partkey % 3 + 1, concat('t', p_size), '_DWORD', 'int'), ' (f', p_partkey,
    ')(int x) { return g(x); }\n', elt(p_size % 2 + 1, concat('t', p_size), '_QWORD'), ' (h', p_partkey, ')(', elt(p_size % 2 + 1, '_BYTE', 'char'), ' *p) { return 0; }\n')"""


@query("txt11_known_types", """
select p_partkey as file_id, unnest(['f' || cast(p_partkey as string), 'h' || cast(p_partkey as string)]) as func_name from part""")
def _(v):
    files = v("part").select(F.col("p_partkey").alias("file_id"), F.expr(_TYPED).alias("code"))
    return tokens.functions(tokens.top_level_items(files, "file_id"), "file_id").select("file_id", "func_name")
