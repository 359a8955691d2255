"""Golden rows for C text, tokens and decompiled code."""

import json

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import ccode
from corpusflow.operators import matching, tokens, trees
from corpusflow.plans import match_run

DECLARATORS = """
typedef unsigned word_t;

word_t *(*pick(word_t **rows, int n))(char tag)
{ }

void (*on_event(int code, void (*old)(int)))(int) {
}
"""


def files(spark, *codes):
    return spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "f bigint, code string")


def value(spark, column, **fields):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in fields.items()])
    return row.select(column.alias("x")).first()["x"]


def test_positions_of_type_tokens(spark):
    rows = tokens.tokens(files(spark, DECLARATORS), "f").orderBy("pos").collect()
    found = [(r.pos, r.value) for r in rows if r.value in {"unsigned", "word_t", "int", "char", "void"}]
    assert found == [
        (1, "unsigned"), (2, "word_t"), (4, "word_t"), (10, "word_t"), (15, "int"), (20, "char"), (25, "void"), (30, "int"),
        (33, "void"), (39, "int"), (44, "int"),
    ]
    assert [r.pos for r in rows] == list(range(48))


def test_functions_with_nested_declarators(spark):
    found = tokens.functions(tokens.top_level_items(files(spark, DECLARATORS), "f"), "f").collect()
    by_name = {r.func_name: " ".join(r.tokens) for r in found}
    assert by_name == {
        "pick": "word_t * ( * pick ( word_t * * rows , int n ) ) ( char tag ) { }",
        "on_event": "void ( * on_event ( int code , void ( * old ) ( int ) ) ) ( int ) { }",
    }


def test_position_zero_counts_as_missing_and_specifiers_are_cut(spark):
    items = tokens.top_level_items(files(spark, "int f(int a) { }", ";static const char *g(void) { }"), "f")
    found = {r.func_name: " ".join(r.tokens) for r in tokens.functions(items, "f").collect()}
    assert found == {"f": "f ( int a ) { }", "g": "char * g ( void ) { }"}


def test_last_definition_of_a_name_counts(spark):
    items = tokens.top_level_items(files(spark, ";int f(void) { return 1; } int f(void) { return 2; }"), "f")
    assert [" ".join(r.tokens) for r in tokens.functions(items, "f").collect()] == ["int f ( void ) { return 2 ; }"]


def test_old_style_definition_is_rejected(spark):
    items = tokens.top_level_items(files(spark, "int f(a) int a; { return a; } struct s { int b; }; int x[] = {1, 2};"), "f")
    assert tokens.functions(items, "f").count() == 0
    assert [(r.reason) for r in tokens.rejected_items(items, "f").collect()] == ["body_only"]


def test_tokens_tile_the_text_and_keep_long_literals_whole(spark):
    literal = '"' + r"\xED\xFF" * 20000 + '"'
    code = f"char *s = {literal};\n\tL'\\'' 0x1Fu 1.5e-3f a->b ... é"
    rows = tokens.tokens(files(spark, code), "f").orderBy("pos").collect()
    assert all(code[r.offset:r.offset + len(r.value)] == r.value for r in rows)
    assert [r.value for r in rows][4] == literal
    assert [(r.value, r.type, r.line, r.col) for r in rows][-7:] == [
        ("0x1Fu", "number", 2, 8), ("1.5e-3f", "number", 2, 14), ("a", "id", 2, 22), ("->", "op", 2, 23), ("b", "id", 2, 25),
        ("...", "op", 2, 27), ("é", "op", 2, 31),
    ]


def test_strings_hide_braces(spark):
    rows = tokens.tokens(files(spark, 'int f(void) { g("}"); { } } int h;'), "f")
    starts = spark.createDataFrame([(0, 0)], "f bigint, start bigint")
    right = tokens.matching_brace(rows, starts, "f").first().right
    assert rows.filter(F.col("pos") == right).first().offset == 26
    open_ended = tokens.tokens(files(spark, "{ { }"), "f")
    assert tokens.matching_brace(open_ended, starts, "f").first().right is None


def test_token_at(spark):
    rows = tokens.tokens(files(spark, "\n  a b\n\nc"), "f")
    probes = spark.createDataFrame(
        [(0, 1, 1, 1), (0, 2, 2, 3), (0, 3, 2, 4), (0, 4, 3, 9), (0, 5, 0, 1), (0, 6, 9, 1)], "f bigint, p bigint, line bigint, col bigint"
    )
    found = {r.p: r.token_pos for r in tokens.token_at(rows, probes, "f", "p").collect()}
    assert found == {1: None, 2: 0, 3: 0, 4: 1, 5: None, 6: 2}


def test_splice_and_extract_round_trip(spark):
    source = files(spark, "int a;\nint f(void) { return 1; }\nint b; int g(void) { }\n")
    found = tokens.functions(tokens.top_level_items(source, "f"), "f")
    new = spark.createDataFrame([(0, "f", "int f(void)\n{ x; }"), (0, "g", "G")], "f bigint, func_name string, replacement string")
    spliced = tokens.spliced(source, found, new, "f")
    text = spliced.first().code
    assert text.startswith("int a;\n\ntypedef int __func__f__begin;\nint f(void)\n{ x; }\ntypedef int __func__f__end;\n\nint b; ")
    again = spliced.select(F.inline(ccode.marked_functions(F.col("code")))).collect()
    assert {r.name: r.text for r in again} == {"f": "int f(void)\n{ x; }", "g": "G"}


def test_markers_need_both_ends_and_the_last_counts(spark):
    b, e = "typedef int __func__{}__begin;", "typedef int __func__{}__end;"
    code = "\n".join([b.format("f"), "old", b.format("f"), "new", e.format("f"), b.format("g"), "x"])
    rows = files(spark, code).select(F.inline(ccode.marked_functions(F.col("code")))).collect()
    assert [(r.name, r.text) for r in rows] == [("f", "new")]


def test_decompiled_text(spark):
    raw = F.col("raw")
    assert value(spark, ccode.with_full_name(raw, F.lit("_9fold")), raw="9fold(a9fold, 9fold)") == "_9fold(a9fold, _9fold)"
    assert value(spark, ccode.with_full_name(raw, F.lit("_")), raw="abc") == "abc"
    assert value(spark, ccode.with_full_name(raw, F.lit("_a$b")), raw="a$b + a") == "_a$b + a"
    assert value(spark, ccode.without_registers(raw), raw="a1@<rdi> x@<XMM>") == "a1 x@<XMM>"
    assert value(spark, ccode.without_header(raw), raw="a typedef int __end_of_fake_libc__;b typedef int __end_of_fake_libc__;c") == "c"
    assert value(spark, ccode.without_header(raw), raw="abc") == "abc"
    assert value(spark, ccode.without_line_controls(raw), raw="# 1\nint a;\n#x\n#") == "int a;\n#"
    assert value(spark, ccode.without_line_controls(raw, True), raw="# 1\nint a;\n#x\n#") == "\nint a;\n\n"


def test_prefix_is_not_in_the_code(spark):
    first = value(spark, ccode.safe_prefix(F.col("raw")), raw="x")
    assert first.startswith("v") and len(first) == 4
    code = "x" + "".join(value(spark, ccode.safe_prefix(F.lit("x")), raw="x"))
    other = value(spark, ccode.safe_prefix(F.col("raw")), raw=code)
    assert other is not None and other not in code


def test_conflicting_variables_are_put_aside(spark):
    rows = spark.createDataFrame(
        [("s", "f", 1, "@@VAR_1@@a@@x @@VAR_1@@a@@x @@VAR_2@@b@@y"), ("s", "g", 2, "@@VAR_1@@a@@x @@VAR_1@@a@@z")],
        "sha string, func_name string, line_pos bigint, raw_code string",
    )
    good, bad = matching.cleaned_functions(rows)
    row = good.first()
    assert {k.split("_")[1]: tuple(v) for k, v in row.variable_names.items()} == {"1": ("a", "x"), "2": ("b", "y")}
    assert [(r.func_name, r.reason) for r in bad.collect()] == [("g", "conflicting_names")]


def test_dialect_keeps_strings_and_drops_calls(spark):
    code = 'int __fastcall f(__int64 a) __attribute__((noreturn, format(printf, (1), 2))) { s = "__int64"; a__int64 = 1; volatile int b; }'
    assert value(spark, ccode.normalised(F.col("raw")), raw=code) == \
        'int  f(long long a)  { s = "__int64"; a__int64 = 1; volatile int b; }'


@pytest.mark.parametrize("message,line,expected", [
    ("x.c:3:8: before: foo", "(type) foo;", "type"),
    ("x.c:3:16: before: t", "int func(const t v)", "t"),
    ("x.c:3:2: before: b", '"a b" b', None),
    ("other error", "a b", None),
    ("x.c:3:1: before: a", "a b", None),
])
def test_undefined_types(spark, message, line, expected):
    assert value(spark, ccode.error_type(F.col("m"), F.col("l")), m=message, l=line) == expected


def test_undecodable_lines_do_not_hide_earlier_ones(spark):
    source = spark.createDataFrame([("h", ";int _f(int a) { return a; }")], "sha string, code string")
    code = lambda n: json.dumps({"function": "_f", "raw_code": f"int f(int @@VAR_{n}@@a1@@k) {{ }}", "ast": {}})
    lines = spark.createDataFrame(
        [("h", 1, code(1)), ("h", 2, code(2)), ("h", 3, '{"function": "_f", "raw_code": "cut'), ("h", 4, '{"function": "other"}'),
         ("z", 5, code(5)), ("h", 6, '{"no": 1}')],
        "sha string, line_pos bigint, line string",
    )
    row = match_run.matched_functions(source, lines).collect()
    assert len(row) == 1 and row[0].original_tokens[:3] == ["int", "_f", "("]
    assert [k.split("_")[1] for k in row[0].variable_names] == ["2"]
    assert row[0].decompiled_tokens[:3] == ["int", "_f", "("]


def test_tree_round_trip_and_depth(spark):
    deep = {"_t": "X", "n": 1, "_p": 3, "_c": {"only": None}}
    for i in range(400):
        deep = {"_t": "L", "v": 'q"é', "_p": None, "_c": {"items": [{"_t": "E", "_p": i, "_c": {}}, deep], "none": None}}
    frame = spark.createDataFrame([(1, json.dumps(deep, ensure_ascii=False)), (2, "{broken")], "k bigint, ast string")
    rows = trees.nodes(frame, ["k"], "ast")
    assert rows.count() == 801 and [r.k for r in trees.undecodable(frame, ["k"], "ast").collect()] == [2]
    back = json.loads(trees.to_json(rows, ["k"]).first().ast)

    def bare(node):
        return {k: ({s: [bare(x) for x in c] if isinstance(c, list) else c and bare(c) for s, c in v.items()} if k == "_c" else v)
                for k, v in node.items() if k != "_p"}

    assert back == bare(deep)
    size = trees.fold(rows, ["k"], {"n": ("sum", F.lit(1)), "low": ("min", F.col("token_pos")), "deep": ("max", F.col("depth"))}).filter("root = 0").first()
    assert (size.n, size.low, size.deep) == (801, 0, 400)


def test_trees_deeper_than_any_decoder_recurses(spark):
    depth = 20_000
    text = '{"_t":"L","_p":1,"_c":{"x":' * depth + '{"_t":"E","_p":7,"_c":{}}' + "}}" * depth
    frame = spark.createDataFrame([(1, text), (2, text[:-1]), (3, text + "]")], "k bigint, ast string")
    rows = trees.nodes(frame, ["k"], "ast")
    assert {r.k for r in trees.undecodable(frame, ["k"], "ast").collect()} == {2, 3}
    found = {r.root: (r.n, r.low) for r in trees.fold(rows, ["k"], {"n": ("sum", F.lit(1)), "low": ("min", F.col("token_pos"))}).collect()}
    assert found == {i: (depth + 1 - i, 1 if i < depth else 7) for i in range(depth + 1)}


def test_texts_that_are_no_tree(spark):
    texts = [
        "[]", '{"a":[1,-2.5e3,"x\\\"]}",null,true,{}],"b":{"c":{}}}', ' [ 1 , { "k" : [ ] } ] ', '"s"', "[1,]", "[1 2]", '{"a"}', '{"a":}', '{"a":1,}',
        '{"a" 1}', "[", "]", "[1}", "", "1 2", '{1:2}', "[,1]", "{,}", "nul", '{"a"::1}', None, '{"_t":"A","_c":{"x":[{"_t":"B","_c":{}}}]}', '{"_t":"A","_c":{"x":{"_t":"B","_c":{]}}}',
        '{"_t":"A","_c":{}}}', '{"_t":"A","_c":{}} {"_t":"A","_c":{}}', '{"_t":"A","_c":{"x":{"_t":"B","_c":{}},}}',
    ]
    good = ['{"_t":"A","_c":{}}', ' {"_t" : "A" , "names" : [ "in}t" , "[" ] , "_c" : { "x" : [ { "_t":"B","_c":{}} , {"_t":"C\\\\","_c":{}} ] } , "q" : "\\"{" } ', '{"a":[1,"x\\"]}"],"node_type":"n","children":[{"x":null},{}]}']
    frame = spark.createDataFrame(list(enumerate(texts + good)), "k bigint, ast string")
    bad = {r.k for r in trees.undecodable(frame, ["k"], "ast").collect()}
    assert bad == set(range(len(texts)))
    rows = trees.with_paths(trees.nodes(frame, ["k"], "ast"), ["k"]).orderBy("k", "pre").collect()
    found = {}
    for r in rows:
        found.setdefault(r.k - len(texts), []).append((r.path, r.node_type, json.loads(r.attrs), r.parent, r.ordinal, r.null_slots))
    assert found == {
        0: [("$", "A", {}, None, None, [])],
        1: [("$", "A", {"names": ["in}t", "["], "q": '"{'}, None, None, []), ("$._c.x[0]", "B", {}, 0, 0, []), ("$._c.x[1]", "C\\\\", {}, 0, 1, [])],
        2: [("$", "n", {"a": [1, 'x"]}']}, None, None, []), ("$.children[0]", None, {}, 0, 0, ["x"]), ("$.children[1]", None, {}, 0, 1, [])],
    }


def test_fold_of_some_nodes_only(spark):
    text = '{"_t":"A","_p":4,"_c":{"x":[{"_t":"B","_p":1,"_c":{}},{"_t":"C","_p":2,"_c":{"y":{"_t":"D","_p":9,"_c":{}}}}]}}'
    rows = trees.nodes(spark.createDataFrame([(1, text)], "k bigint, ast string"), ["k"], "ast").filter("node_type <> 'B'")
    types = (lambda a, b: F.concat_ws(" ", a, b), F.col("node_type"))
    found = trees.fold(rows, ["k"], {"types": types, "n": ("sum", F.lit(1)), "low": ("min", F.col("token_pos"))}).collect()
    assert {r.root: (r.types, r.n, r.low) for r in found} == {0: ("A C D", 3, 2), 2: ("C D", 2, 2), 3: ("D", 1, 9)}


def test_any_associative_fold(spark):
    """Ordered and struct-valued folds on a chain, a comb and a wide tree, against a plain walk."""
    leaf = lambda i: {"_t": f"t{i}", "_p": i, "_c": {}}
    chain = leaf(0)
    for i in range(1, 70):
        chain = {"_t": f"t{i}", "_p": None if i % 3 else i, "_c": {"x": chain} if i % 2 else {"a": [leaf(100 + i), chain], "b": leaf(200 + i)}}
    trees_ = [leaf(1), chain, {"_t": "w", "_p": 1, "_c": {"items": [leaf(i) for i in range(50)], "none": None}}]
    frame = spark.createDataFrame([(k, json.dumps(t)) for k, t in enumerate(trees_)], "k bigint, ast string")
    expected = {}

    def walk(k, node, rows):
        at = len(rows)
        rows.append((node["_t"], node["_p"]))
        for child in node["_c"].values():
            for c in child if isinstance(child, list) else [child] if child else []:
                walk(k, c, rows)
        positions = [p for _, p in rows[at:] if p is not None]
        expected[k, at] = (" ".join(t for t, _ in rows[at:]), (positions[0], positions[-1]) if positions else (None, None))

    for k, t in enumerate(trees_):
        walk(k, t, [])
    span = lambda a, b: F.struct(F.coalesce(a["l"], b["l"]).alias("l"), F.coalesce(b["r"], a["r"]).alias("r"))
    own = F.struct(F.col("token_pos").alias("l"), F.col("token_pos").alias("r"))
    rows = trees.fold(trees.nodes(frame, ["k"], "ast"), ["k"], {"types": (lambda a, b: F.concat_ws(" ", a, b), F.col("node_type")), "span": (span, own)})
    assert {(r.k, r.root): (r.types, tuple(r.span)) for r in rows.collect()} == expected


def test_trees_of_lines_are_cut_alike_at_any_depth(spark):
    deep = '{"a": [' * 1500 + '"s, ]}"' + "]}" * 1500
    lines = [
        '{"function":"f","raw_code":"c","ast":' + deep + ',"other":{"z":1}}', '{"other":{"ast":{"no":1}},"raw_code":"\\"ast\\":{","ast" : {"x" : [ ] }}', '{"ast":null}', '{"raw_code":"c"}',
    ]
    frame = spark.createDataFrame(list(enumerate(lines)), "n bigint, line string")
    got = {r.n: r.t for r in frame.select("n", ccode.tree_of(F.col("line")).alias("t")).collect()}
    assert got == {0: deep.replace('": [', '":['), 1: '{"x":[]}', 2: None, 3: None}


def test_macros_with_arguments_of_any_depth(spark):
    nest = lambda n: "(" * n + "x" + ")" * n
    cases = {
        f"int f {nest(2)} __attribute__ {nest(70)} {{ }}": f"int f {nest(2)}  {{ }}", f"__attribute__{nest(1)}{nest(3)}": nest(3),
        '__attribute__((a(")")))b': "b", "__attribute__ ((open": "__attribute__ ((open", "volatile int x": "volatile int x", "__attribute__ y (z)": "__attribute__ y (z)",
    }
    frame = spark.createDataFrame([(c,) for c in cases], "c string")
    assert {r.c: r.n for r in frame.select("c", ccode.normalised(F.col("c")).alias("n")).collect()} == cases


def test_names_that_hold_control_characters_stay(spark):
    from corpusflow.functions import loglines

    assert value(spark, loglines.groups(F.col("l"), r"(\S+)-(\S+)", 2), l="x a\x01b-c y") == ["a\x01b", "c"]
    assert value(spark, loglines.groups(F.col("l"), r"(\S+)-(\S+)", 2), l="a\x01b\x01c") is None


def test_lines_may_nest_as_deep_as_they_like(spark):
    deep = lambda n: '{"a":' * n + "1" + "}" * n
    lines = [(n, '{"function": "_f", "raw_code": "c", "ast": ' + deep(n) + "}") for n in (10, 1500, 5000)]
    frame = spark.createDataFrame(lines, "n bigint, line string")
    for with_ast in (True, False):
        good, bad = matching.decoded_lines(frame, with_ast)
        assert sorted(r.n for r in good.collect()) == [10, 1500, 5000] and bad.count() == 0
    assert {r.n: len(r.ast) for r in matching.decoded_lines(frame)[0].collect()} == {n: len(deep(n)) for n, _ in lines}
