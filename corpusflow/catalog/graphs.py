"""Control graphs and variables."""

from pyspark.sql import functions as F

from corpusflow.catalog.registry import query
from corpusflow.operators import graph
from corpusflow.operators.trees import renamed_parts


@query("jn14_nearest_addresses", """
with recursive w as (select node_id, parent_id as ptr, cast(null as bigint) as pred_ea from $tree where parent_id is null
    union all select t.node_id, t.parent_id, coalesce(p.ea, w.pred_ea) from $tree t join w on t.parent_id = w.node_id join $tree p on p.node_id = t.parent_id)
select node_id, pred_ea from w""")
def _(v):
    return graph.nearest_addresses(v("tree"), [])


@query("jn14_inherited_uses", """
with recursive w as (select node_id, parent_id as ptr, cast(null as bigint) as pred_ea from $tree where parent_id is null
    union all select t.node_id, t.parent_id, coalesce(p.ea, w.pred_ea) from $tree t join w on t.parent_id = w.node_id join $tree p on p.node_id = t.parent_id)
select node_id, coalesce(t.ea, pred_ea) as ea from w join $tree t using (node_id) where coalesce(t.ea, pred_ea) is not null""")
def _(v):
    tree = v("tree")
    uses = graph.with_inherited_addresses(tree.select("node_id", "ea"), graph.nearest_addresses(tree, []), [])
    return uses.select("node_id", "ea")


# The tree with a second predecessor for some nodes, and with nodes whose only predecessor is their own child, which makes cycles.
_EDGES = """(select case when node_id % 50 = 49 then node_id * 2 + 1 else parent_id end as src, node_id as dst from $tree where parent_id is not null
    union all select node_id + 1 as src, node_id as dst from $tree where node_id % 7 = 3)"""


@query("jn14_nearest_in_graph", f"""
with recursive p as (select dst, min(src) as src from {_EDGES} group by dst having count(*) = 1),
w as (select t.node_id, p.src as ptr from $tree t join p on p.dst = t.node_id
    union select w.node_id, p.src from w join $tree t on t.node_id = w.ptr join p on p.dst = w.ptr where t.ea is null),
f as (select w.node_id, t.ea from w join $tree t on t.node_id = w.ptr where t.ea is not null)
select t.node_id, f.ea as pred_ea from $tree t left join f using (node_id)""")
def _(v):
    tree = v("tree")
    own = tree.filter("parent_id is not null").select(F.expr("case when node_id % 50 = 49 then node_id * 2 + 1 else parent_id end").alias("src"), F.col("node_id").alias("dst"))
    joins = tree.filter("node_id % 7 = 3").select((F.col("node_id") + 1).alias("src"), F.col("node_id").alias("dst"))
    return graph.nearest_in_graph(tree.select("node_id", "ea"), own.unionByName(joins), [])


@query("agg21_degrees", """
select t.node_id, coalesce(s.n, 0) as nsucc, case when t.parent_id is null then cast(0 as bigint) else 1 end as npred
from $tree t left join (select parent_id, count(*) as n from $tree group by parent_id) s on s.parent_id = t.node_id""")
def _(v):
    edges = v("tree").filter("parent_id is not null").select(F.col("parent_id").alias("src"), F.col("node_id").alias("dst"))
    return graph.degrees(v("tree"), edges, [])


@query("agg21_adjacency", """
select parent_id as node_id, cast(floor(node_id / 1024) as bigint) as piece, string_agg(cast(node_id as string), ',' order by node_id) as neighbours
from $tree where parent_id is not null group by all""")
def _(v):
    edges = v("tree").filter("parent_id is not null").select(F.col("parent_id").alias("src"), F.col("node_id").alias("dst"))
    return graph.adjacency(edges, [], "src", "dst").withColumn("neighbours", F.array_join("neighbours", ","))


_SETS = """
with p as (select binary_id, func_id, name, cast(floor(ea / 65536) as bigint) as page, count(distinct ea) as n,
    sha256(string_agg(distinct cast(ea as string), ',' order by ea)) as d from $var_use
    where not regexp_matches(name, '^(v|a)[0-9]+$') group by all),
p2 as (select binary_id, func_id, name, cast(floor(ea / 65536) as bigint) as page, count(distinct ea) as n,
    sha256(string_agg(cast(ea as string), ',' order by ea)) as d from (select distinct binary_id, func_id, name, ea from $var_use) group by all),
a as (select binary_id, func_id, name, cast(sum(n) as bigint) as n_addresses, sha256(string_agg(d, ',' order by page)) as addr_key from p2 group by all),
k as (select binary_id, addr_key, case when count(*) > 1 then '::NONE::' else min(name) end as new_name from a
    where not regexp_matches(name, '^(v|a)[0-9]+$') group by all)"""
_SETS = "with " + _SETS[_SETS.index("p2 as"):]


@query("agg12_address_sets", _SETS + r"""
select binary_id, func_id, name, n_addresses, addr_key from a where not regexp_matches(name, '^(v|a)[0-9]+$')""")
def _(v):
    return graph.address_sets(v("var_use"))


@query("agg13_address_names", _SETS + " select binary_id, addr_key, new_name from k")
def _(v):
    return graph.address_names(v("var_use"))


_RENAMED = _SETS + """,
r as (select u.binary_id, u.func_id, 's' || u.name as name, u.first_visit, case when k.new_name <> '::NONE::' then k.new_name else 's' || u.name end as new_name
    from (select binary_id, func_id, name, min(visit) as first_visit from $var_use group by all) u join a using (binary_id, func_id, name) left join k using (binary_id, addr_key))"""


@query("jn12_renamed_variables", _RENAMED + " select * from r")
def _(v):
    stripped = v("var_use").withColumn("name", F.concat(F.lit("s"), F.col("name")))
    return graph.rename_variables(stripped, graph.address_names(v("var_use")))


@query("win05_variable_ids", _RENAMED + """
select *, '@@VAR_' || cast(var_id as string) || '@@' || name || '@@' || new_name as marked
from (select *, row_number() over (partition by binary_id order by first_visit) - 1 as var_id from r)""")
def _(v):
    from corpusflow.plans.decompile_run import recovered_names

    return recovered_names(v("var_use"), v("var_use").withColumn("name", F.concat(F.lit("s"), F.col("name"))))


@query("js07_renamed_parts", r"""
with p as (select sha, line_pos, unnest(regexp_extract_all(raw_code, '@@VAR_\d+@@[^@]+@@\w+')) as name from $decompiled)
select sha, line_pos, split_part(name, '@@', 2) as var_id, split_part(name, '@@', 3) as old_name, split_part(name, '@@', 4) as new_name from p""")
def _(v):
    names = F.regexp_extract_all("raw_code", F.lit(r"@@VAR_\d+@@[^@]+@@\w+"), F.lit(0))
    var_id, old, new = renamed_parts(F.col("name"))
    return v("decompiled").select("sha", "line_pos", F.explode(names).alias("name")).select("sha", "line_pos", var_id.alias("var_id"), old.alias("old_name"), new.alias("new_name"))
