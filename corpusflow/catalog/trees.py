"""Syntax trees."""

from pyspark.sql import functions as F

from corpusflow.catalog.registry import query
from corpusflow.operators import trees

_C_NODES = """(select func_id, replace(t.fullkey, '"', '') as path, json_extract_string(t.value, '$._t') as node_type, cast(json_extract_string(t.value, '$._p') as bigint) as token_pos
    from $c_ast, json_tree(ast) t where t.type = 'OBJECT' and json_extract_string(t.value, '$._t') is not null)"""
_D_NODES = """(select func_id, replace(t.fullkey, '"', '') as path, json_extract_string(t.value, '$.node_type') as node_type, cast(json_extract_string(t.value, '$.node_id') as bigint) as node_id
    from $ctree, json_tree(ast) t where t.type = 'OBJECT' and json_extract_string(t.value, '$.node_type') is not null)"""


@query("js02_c_nodes", f"select * from {_C_NODES}")
def _(v):
    rows = trees.with_paths(trees.nodes(v("c_ast"), ["func_id"], "ast"), ["func_id"])
    return rows.select("func_id", "path", "node_type", "token_pos")


@query("js02_decompiler_nodes", f"select * from {_D_NODES}")
def _(v):
    rows = trees.with_paths(trees.nodes(v("ctree"), ["func_id"], "ast"), ["func_id"])
    node_id = F.get_json_object("attrs", "$.node_id").cast("bigint")
    return rows.select("func_id", "path", "node_type", node_id.alias("node_id"))


_FOLD = f"""
with n as {_C_NODES}
select a.func_id, a.path, count(*) as n_nodes, min(d.token_pos) as min_pos from n a join n d on d.func_id = a.func_id
    and (d.path = a.path or starts_with(d.path, a.path || '.')) group by all"""


@query("js03_subtree_folds", _FOLD)
def _(v):
    rows = trees.with_paths(trees.nodes(v("c_ast"), ["func_id"], "ast"), ["func_id"])
    folded = trees.fold(rows, ["func_id"], {"n_nodes": ("sum", F.lit(1)), "min_pos": ("min", F.col("token_pos"))}, ("path",))
    return folded.drop("root")


@query("udf02_custom_fold", f"""
with n as {_C_NODES}
select a.func_id, a.path, count(*) filter (where d.node_type = 'ID') as n_ids from n a join n d on d.func_id = a.func_id
    and (d.path = a.path or starts_with(d.path, a.path || '.')) group by all""")
def _(v):
    rows = trees.with_paths(trees.nodes(v("c_ast"), ["func_id"], "ast"), ["func_id"])
    return trees.fold(rows, ["func_id"], {"n_ids": ("sum", (F.col("node_type") == "ID").cast("bigint"))}, ("path",)).drop("root")


_ORDERED = """(select func_id, replace(t.fullkey, '"', '') as path, t.id as place, json_extract_string(t.value, '$._t') as node_type,
    cast(json_extract_string(t.value, '$._p') as bigint) as token_pos from $c_ast, json_tree(ast) t
    where t.type = 'OBJECT' and json_extract_string(t.value, '$._t') is not null)"""


@query("js03_ordered_folds", f"""
with n as {_ORDERED}
select a.func_id, a.path, string_agg(d.node_type, ' ' order by d.place) as types,
    cast(max((length(d.path) - length(replace(d.path, '._c.', ''))) / 4) as int) as deepest
from n a join n d on d.func_id = a.func_id and (d.path = a.path or starts_with(d.path, a.path || '.')) group by all""")
def _(v):
    rows = trees.with_paths(trees.nodes(v("c_ast"), ["func_id"], "ast"), ["func_id"])
    types = (lambda a, b: F.concat_ws(" ", a, b), F.col("node_type"))
    return trees.fold(rows, ["func_id"], {"types": types, "deepest": ("max", F.col("depth"))}, ("path",)).drop("root")


@query("udf02_struct_fold", f"""
with n as {_ORDERED}
select a.func_id, a.path, arg_min(d.token_pos, d.place) filter (d.token_pos is not null) as leftmost,
    arg_max(d.token_pos, d.place) filter (d.token_pos is not null) as rightmost, count(*) as n_nodes
from n a join n d on d.func_id = a.func_id and (d.path = a.path or starts_with(d.path, a.path || '.')) group by all""")
def _(v):
    rows = trees.with_paths(trees.nodes(v("c_ast"), ["func_id"], "ast"), ["func_id"])
    own = F.struct(F.col("token_pos").alias("leftmost"), F.col("token_pos").alias("rightmost"), F.lit(1).cast("bigint").alias("n_nodes"))
    span = lambda a, b: F.struct(
        F.coalesce(a["leftmost"], b["leftmost"]).alias("leftmost"), F.coalesce(b["rightmost"], a["rightmost"]).alias("rightmost"),
        (a["n_nodes"] + b["n_nodes"]).alias("n_nodes"),
    )
    return trees.fold(rows, ["func_id"], {"span": (span, own)}, ("path",)).select("func_id", "path", "span.*")


@query("js04_rebuilt_trees", r"""
select func_id, regexp_replace(ast, '"_p":(\d+|null),', '', 'g') as ast from $c_ast""")
def _(v):
    return trees.to_json(trees.nodes(v("c_ast"), ["func_id"], "ast"), ["func_id"])


@query("js05_rebased_positions", f"""
select func_id, path, token_pos - min(token_pos) over (partition by func_id) as token_pos from {_C_NODES}""")
def _(v):
    rows = trees.with_paths(trees.nodes(v("c_ast"), ["func_id"], "ast"), ["func_id"]).select("func_id", "path", "token_pos")
    left = rows.groupBy("func_id").agg(F.min("token_pos").alias("left"))
    return trees.rebased(rows.join(left, "func_id"), F.col("left")).drop("left")
