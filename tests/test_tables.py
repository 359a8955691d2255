"""Golden rows for state, joins, windows and files."""

import pytest
from pyspark.sql import functions as F

from corpusflow import schemas
from corpusflow.functions import ccommand, loglines, names, outcomes
from corpusflow.operators import graph, joins, libraries, logs, ordered, rollups, state
from corpusflow.plans import build_run
from corpusflow.session import working_path
from corpusflow.sources import readers, writers

REPO = "repo_owner string, repo_name string, repo_size bigint, clone_successful boolean, compiled boolean, num_makefiles bigint, num_binaries bigint"
RESULT = "repo_owner string, repo_name string, seq bigint, clone_success boolean, repo_size bigint, has_makefiles boolean, num_makefiles bigint, num_binaries bigint"


def test_repo_names(spark):
    urls = ["https://h/o/r.git", "www.h/o/r", "o/r", "https://api.h/repos/o/r//", "\to/r.git/ ", "", "word", "o/r.git.git"]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "idx bigint, line string")
    good, bad = build_run.named_repos(frame)
    assert [(r.repo_owner, r.repo_name) for r in good.orderBy("idx").collect()] == [("o", "r")] * 5 + [("o", "r.git")]
    assert [r.idx for r in bad.orderBy("idx").collect()] == [5, 6]


def test_unknown_compression_is_an_error(spark):
    path = names.archive_path("a", F.lit("o"), F.lit("r"), F.lit("zip"))
    with pytest.raises(Exception, match="invalid compression"):
        spark.range(1).select(path).collect()


def test_untracked_names(spark):
    output = 'a b.o\n"x\\303\\251.o"\n\n"q\\"t\\\\.o"\n"tab\\t\\x41\\u00e9.o"\n'
    frame = spark.createDataFrame([(1, output)], "k bigint, output string")
    found = [r.file for r in readers.untracked(frame, ["k"], F.col("output")).collect()]
    assert found == ["a b.o", "xÃ©.o", 'q"t\\.o', "tab\tAé.o"]


def test_zero_size_and_unknown_clone_errors(spark):
    known = spark.createDataFrame([("o", "a", 5, True, True, 1, 1)], REPO)
    results = spark.createDataFrame([
        ("o", "a", 1, None, 7, False, None, None), ("o", "b", 2, None, None, False, None, None), ("o", "c", 3, True, 0, True, 2, 3),
    ], RESULT)
    after = {r.repo_name: r for r in build_run.apply_results(known, results).collect()}
    assert after["a"].repo_size == 5  # not cloned again: nothing is written
    assert (after["b"].clone_successful, after["b"].repo_size, after["b"].compiled) == (True, -1, False)
    assert (after["c"].repo_size, after["c"].compiled, after["c"].num_makefiles, after["c"].num_binaries) == (-1, True, 2, 3)


def test_first_owner_stays(spark):
    old = spark.createDataFrame([("a", "o", "old", False)], "sha string, repo_owner string, repo_name string, success boolean")
    new = spark.createDataFrame(
        [("a", "x", "y", True, 1), ("b", "o1", "n1", True, 2), ("b", "o2", "n2", False, 3)],
        "sha string, repo_owner string, repo_name string, success boolean, seq int",
    )
    rows = {r.sha: (r.repo_owner, r.repo_name, r.success) for r in state.add_binaries(old, new).collect()}
    assert rows == {"a": ("o", "old", True), "b": ("o1", "n1", False)}


def test_undecodable_makefiles_keep_their_counts(spark):
    base = spark.createDataFrame([("o", "r", 1, True, False, 0, 0, [])], schemas.REPO_STATE)
    bad = F.unhex(F.lit("FF")).cast("string")
    makefile = F.struct(F.lit("d").alias("directory"), F.lit(True).alias("success"), F.array(bad).alias("binaries"), F.array(F.lit("h")).alias("sha256"))
    update = spark.range(1).select(F.lit("o").alias("repo_owner"), F.lit("r").alias("repo_name"), F.array(makefile).alias("makefiles"), F.lit(1).alias("seq"))
    new, report = state.update_makefiles(base, update)
    row = new.first()
    assert (row.compiled, row.num_makefiles, row.num_binaries, row.makefiles) == (True, 1, 1, [])
    assert report.first().outcome == "not_encodable"


def test_index_key_must_exist(spark):
    with pytest.raises(ValueError):
        state.violations(spark.range(1), ["nothing"])
    assert state.violations(spark.createDataFrame([(1,), (1,), (2,)], "id int"), ["id"]).collect()[0]["rows"] == 2


def test_nested_lists_are_cut_to_the_shorter(spark):
    row = ("o", "r", 1, True, True, 1, 2, [("/usr/src/repo/d", True, ["a", "b"], ["h1"]), ("e", False, [], [])])
    flat = rollups.exploded_makefiles(spark.createDataFrame([row], schemas.REPO_STATE))
    assert [(r.directory, r.path, r.sha) for r in flat.collect()] == [("/usr/src/repo/d", "a", "h1")]
    assert rollups.binary_mapping(flat).first().path_in_repo == "o/r/d/a"


def test_last_places_of_nested_binaries_need_no_sort(spark):
    """The same rows as from the flat table, by hash tables alone: a place is a long, not a record of strings."""
    def nested(owner, name, *lists):
        return (owner, name, 1, True, True, 1, 2, [(f"/usr/src/repo/m{i}", True, binaries, hashes) for i, (binaries, hashes) in enumerate(lists)])

    rows = [
        nested("o", "r", (["a", "b"], ["h1", "h2"]), (["a", "c", "a"], ["h1", "h3"])), nested("o", "r", (["x"], ["h3"])), nested("o", "q", (["a"] * 9, ["h1"] * 9)),
        nested(None, "r", (["n", "a"], ["h4", "h1"])), nested("o", None, (["m", "l"], ["h5", "h4"])), nested("z", "e"), nested("p", "r", (["k", "b", "h"], ["h2", "h2", "h6"])),
    ]
    repos = spark.createDataFrame(rows, schemas.REPO_STATE)
    numbered, first = rollups.numbered_makefiles(repos, F.size("makefiles"))
    got = rollups.nested_mapping(numbered, first, lambda i: F.concat(F.lit("/usr/src/repo/m"), i.cast("string")))
    assert sorted(map(str, got.collect())) == sorted(map(str, rollups.binary_mapping(rollups.exploded_makefiles(repos)).collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.split("\n") if "partial_max(place#" in x)
    assert " HashAggregate(" in line


def test_partly_matched_repos_are_processed_again(spark):
    repos = spark.createDataFrame([("o", "a"), ("o", "b"), ("o", "c")], "repo_owner string, repo_name string")
    done = spark.createDataFrame([("o", "a", 0), ("o", "b", 2)], "repo_owner string, repo_name string, funcs_matched_without_ast int")
    assert {r.repo_name for r in joins.unprocessed(repos, done).collect()} == {"b", "c"}
    assert joins.unprocessed(repos, done, force_reprocess=True).count() == 3


def test_budget_is_tested_before_each_makefile(spark):
    runs = spark.createDataFrame([("r", 1, 50), ("r", 2, 20), ("r", 3, 1), ("s", 1, 100)], "repo string, pos bigint, elapsed bigint")
    kept = build_run.within_budget(runs, ["repo"], 60).collect()
    assert {(r.repo, r.pos) for r in kept} == {("r", 1), ("r", 2), ("s", 1)}
    assert build_run.within_budget(runs, ["repo"], None).count() == 4


def test_running_totals_across_blocks(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("pos"))
    for inclusive in (True, False):
        found = ordered.running_total(rows, ["k"], "pos", F.col("pos"), "t", inclusive=inclusive, parts=7).collect()
        for r in found:
            assert r.t == sum(p for p in range(r.k, r.pos + (1 if inclusive else 0), 3))


def test_global_index_is_dense_and_sorted(spark):
    rows = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("key"))
    found = sorted(ordered.global_index(rows, ["key"], "idx").collect())
    assert [r.idx for r in found] == list(range(5000))


def test_skip_to_a_missing_key_gives_nothing(spark):
    rows = spark.range(5).withColumnRenamed("id", "idx")
    assert [r.idx for r in ordered.from_key_on(rows, F.col("idx") == 3, "idx", True).collect()] == [3, 4]
    assert [r.idx for r in ordered.from_key_on(rows, F.col("idx") == 3, "idx", False).collect()] == [4]
    assert ordered.from_key_on(rows, F.col("idx") == 9, "idx", True).count() == 0


def test_log_formats(spark):
    worker = "2020-01-01 10:00:00,123 INFO: (Worker  3) 1 (2) out of 3 Makefile(s) in a-b/c.d compiled (partially), yielding 4 binaries"
    plain = worker.replace("(Worker  3) ", "")
    log = spark.createDataFrame([(1, worker), (2, plain), (3, plain.replace("a-b/c.d", "a_b/c"))], "line_no bigint, line string")
    row = loglines.summaries(log).collect()
    assert [(r.line_no, r.owner, r.name, r.n_partial, r.n_binaries) for r in row] == [(1, "a-b", "c.d", 2, 4)]
    assert [r.line_no for r in loglines.plain_summaries(log).collect()] == [3]


def test_comparison_reports_strict_decreases_and_only_shared_repos(spark):
    schema = "repo string, n_success bigint, n_total bigint"
    old = spark.createDataFrame([("a", 2, 3), ("b", 1, 1), ("c", 1, 1)], schema)
    new = spark.createDataFrame([("a", 1, 4), ("b", 1, 1), ("d", 1, 1)], schema)
    compared = logs.compare(old, new)
    assert [(r.repo, r.message) for r in compared.collect()] == [("a", "n_success 2->1, n_total 3->4")]
    assert [(r.repo, r.tag) for r in logs.decreases(compared).collect()] == [("a", "n_success")]
    assert {(r.repo, r.missing_in) for r in logs.missing_repos(old, new).collect()} == {("c", "NEW"), ("d", "OLD")}


def test_address_sets_that_collide_stay_ambiguous(spark):
    uses = spark.createDataFrame(
        [(1, 1, "x", 10, 1), (1, 1, "x", 70000, 2), (1, 2, "y", 70000, 3), (1, 2, "y", 10, 4), (1, 3, "x", 70000, 5), (1, 3, "x", 10, 6),
         (1, 4, "v7", 5, 7), (1, 4, "only", 5, 8)],
        "binary_id bigint, func_id bigint, name string, ea bigint, visit bigint",
    )
    named = sorted(r.new_name for r in graph.address_names(uses).collect())
    assert named == ["::NONE::", "only"]
    stripped = uses.replace({"x": "v1", "y": "v1", "only": "v2"}, subset=["name"])
    renamed = graph.assign_variable_ids(graph.rename_variables(stripped, graph.address_names(uses)))
    assert [(r.var_id, r.marked) for r in renamed.orderBy("var_id").collect()][:1] == [(0, "@@VAR_0@@v1@@v1")]
    assert {r.marked.split("@@", 2)[2] for r in renamed.filter("func_id = 4").collect()} == {"v7@@only", "v2@@only"}


def test_nearest_address_stops_at_joins(spark):
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (0, 3), (3, 4)] + [(i, i + 1) for i in range(10, 200)], "src bigint, dst bigint")
    ids = [*range(5), *range(10, 201)]
    nodes = spark.createDataFrame([(i, 99 if i == 0 else 7 if i == 10 else None) for i in ids], "node_id bigint, ea bigint")
    joined = nodes.join(graph.single_parents(edges, []), "node_id", "left")
    found = {r.node_id: r.pred_ea for r in graph.nearest_addresses(joined, []).collect()}
    assert (found[1], found[2], found[3], found[4], found[200]) == (99, 99, None, None, 7)


def test_nearest_address_ends_on_cycles(spark):
    parents = {1: 2, 2: 1, 3: 1, 4: 4, 5: 6, 6: 7, 7: 5, 8: 9, 9: None}
    nodes = spark.createDataFrame([(n, p, 70 if n in (7, 9) else None) for n, p in parents.items()], "node_id bigint, parent_id bigint, ea bigint")
    found = {r.node_id: r.pred_ea for r in graph.nearest_addresses(nodes, []).collect()}
    assert found == {1: None, 2: None, 3: None, 4: None, 5: 70, 6: 70, 7: 70, 8: 70, 9: None}


def test_results_keep_the_nested_makefiles(spark):
    from corpusflow.schemas import REPO_STATE

    made = [("d", True, ["p"], ["h"])]
    old = spark.createDataFrame([("o", "a", 5, True, True, 1, 1, made), ("o", "b", 6, True, False, 0, 0, [])], REPO_STATE)
    results = spark.createDataFrame(
        [(1, "o", "a", None, None, False, 0, 0), (2, "o", "b", True, 9, True, 3, 4), (3, "o", "c", True, 0, False, 0, 0)],
        "seq bigint, repo_owner string, repo_name string, clone_success boolean, repo_size bigint, has_makefiles boolean, num_makefiles bigint, num_binaries bigint",
    )
    new = build_run.apply_results(old, results)
    assert set(new.columns) == set(old.columns)
    rows = {r.repo_name: r for r in new.collect()}
    assert [tuple(m) for m in rows["a"].makefiles] == made and rows["c"].makefiles == []
    assert (rows["b"].compiled, rows["b"].num_makefiles, rows["b"].num_binaries, rows["b"].repo_size) == (True, 3, 4, 9)


@pytest.mark.parametrize("lib,packages,expected", [
    ("foo", ["libfoo-dev", "libfoo2-dev", "foo"], (1, 0, "libfoo-dev")),
    ("foo", ["libfoo-1.2-dev", "libfoo", "foo-dev"], (2, 0, "libfoo-1.2-dev")),
    ("foo", ["libfoo12", "xlibfoo"], (3, 0, "libfoo12")),
    ("foo", ["zfoo-dev", "afoo-dev"], (4, 1, "afoo-dev")),
    ("a_b", ["liba-b-dev", "liba_b-dev"], (1, 0, "liba-b-dev")),
    ("a-b", ["liba_b-dev"], None),
    ("c++", ["libc++-dev", "libccc-dev"], (1, 0, "libc++-dev")),
    ("a.b.c", ["xaxbyc"], (5, 1, "xaxbyc")),
    ("foo", ["bar"], None),
])
def test_best_package(spark, lib, packages, expected):
    libs = spark.createDataFrame([(lib,)], "lib string")
    catalogue = spark.createDataFrame([(p,) for p in packages], "pkg string")
    rows = [(r.priority, r.outside, r.pkg) for r in libraries.best_packages(libs, catalogue).collect()]
    assert rows == ([expected] if expected else [])


def test_packages_that_install_too_much_fall_back(spark):
    libs = spark.createDataFrame([("foo",), ("a*",)], "lib string")
    catalogue = spark.createDataFrame([("libfoo-dev",), ("foo",)], "pkg string")
    installs = spark.createDataFrame([("libfoo-dev", 51)], "pkg string, new_installs int")
    # The third pattern also finds libfoo-dev; only the plain name finds another package.
    assert libraries.best_packages(libs, catalogue, installs).first().pkg == "foo"
    # Pattern characters in a name stand for themselves.
    literal = libraries.best_packages(libs, catalogue.union(spark.createDataFrame([("liba*-dev",), ("liba-dev",)], "pkg string")))
    assert {r.lib: r.pkg for r in literal.collect()} == {"foo": "libfoo-dev", "a*": "liba*-dev"}


def test_library_log_of_a_failing_command(spark):
    commands = spark.createDataFrame([
        ("gcc -lpthread -l m -lopencv -lopenmp -llibrary_with_random_name nonexistent_file.c", 1), ("gcc -lz ok.c", 0),
    ], "cmd string, rc int")
    found = {r.library for r in ccommand.failed_libraries(commands, []).collect()}
    assert found == {"pthread", "m", "opencv", "openmp", "library_with_random_name"}
    packages = spark.createDataFrame([("pkg-config --libs gtk+-2.0 x11", 1)], "cmd string, rc int")
    assert {r.library for r in ccommand.failed_packages(packages, []).collect()} == {"gtk+-2.0", "x11"}


def test_effective_command(spark):
    commands = spark.createDataFrame([
        ("gcc -c -O3 -Wall a/x.c b.c -I inc -march native -ggdb3 -fPIC",), ("cc main.c -o  prog -O 2 -lm",), ("gcc -Wno-x y.o",),
    ], "cmd string")
    rows = ccommand.parsed(commands).collect()
    assert [r.object for r in rows] == ["b.o", "prog", "a.out"]
    assert [r.effective for r in rows] == [
        "gcc -c a/x.c b.c -I inc -fPIC -o b.o -O0 -g", "gcc main.c -o prog -O0 -g -lm", "gcc -Wno-x y.o -o a.out -O0 -g",
    ]


def test_status_and_outcomes(spark):
    rows = spark.createDataFrame([(False, 1), (False, 0), (True, 1), (True, 0)], "e boolean, m int")
    assert [r.s for r in rows.select(outcomes.match_status(F.col("e"), F.col("m")).alias("s")).collect()] == [
        "success", "warning", "warning", "error",
    ]


def test_report_marks_unrecorded_makefiles(spark):
    keys = ["repo", "dir"]
    dirs = spark.createDataFrame([("r", "a"), ("r", "b")], "repo string, dir string")
    recorded = spark.createDataFrame([("r", "a", False)], "repo string, dir string, success boolean")
    report = logs.makefile_report(dirs, recorded, keys)
    assert {(r.dir, r.status) for r in report.collect()} == {("a", ""), ("b", "Failed")}
    path = working_path(spark, "report")
    writers.makefile_report(report, path)
    text = [r.value for r in spark.read.text(path).collect()]
    assert "Repo,Makefile,Status,Failed Reason?" in text and "r,b,Failed," in text


def test_lines_keep_file_order(spark):
    path = working_path(spark, "lines")
    spark.range(0, 20000, 1, 1).select(F.col("id").cast("string").alias("value")).write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        assert readers.lines(spark, path).filter("idx <> cast(value as bigint)").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_numbers_hold_when_splits_change(spark):
    path = working_path(spark, "numbers")
    spark.range(5000).select(F.col("id").cast("string").alias("value")).repartitionByRange(3, F.col("value").cast("long")).sortWithinPartitions(F.col("value").cast("long")).write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
        numbered = readers.lines(spark, path)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "777")  # as when executors come or go between two reads
        assert numbered.filter("idx = cast(value as bigint)").count() == numbered.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_corrupt_result_files_count_as_empty(spark, tmp_path):
    path = f"{tmp_path}/results"
    repos = spark.createDataFrame([("o", "a"), ("o", "b")], "repo_owner string, repo_name string")
    rows = spark.createDataFrame([("o", "a", [("d", True, ["x"], ["h"])])], schemas.REPO_RESULT)
    rows.write.parquet(path)
    with open(f"{path}/broken.parquet", "wb") as f:
        f.write(b"not a table")
    found = {r.repo_name: len(r.makefiles) for r in readers.repo_results(spark, path, repos).collect()}
    assert found == {"a": 1, "b": 0}


def test_decompiled_lines_of_named_files(spark, tmp_path):
    path = str(tmp_path)
    with open(f"{path}/abc123.jsonl", "w") as f:
        f.write('{"function": "f"}\n\n{"function": "g"}\n')
    rows = readers.decompiled_lines(spark, path).orderBy("line_pos").collect()
    assert [(r.sha, r.line) for r in rows] == [("abc123", '{"function": "f"}'), ("abc123", '{"function": "g"}')]


def test_stream_restarts_without_counting_twice(spark):
    from corpusflow.streaming.results import ResultFold, start

    base = working_path(spark, "stream")
    schema = RESULT + ", funcs_matched bigint, without_ast bigint, library string"
    initial = spark.createDataFrame([("o", "a", 5, True, True, 1, 1)], REPO)

    def arrive(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")

    def run():
        fold = ResultFold(spark, base, initial)
        start(spark.readStream.schema(schema).parquet(f"{base}/in"), fold).awaitTermination()
        return fold

    arrive(("o", "b", 1, True, 10, True, 2, 2, 3, 1, "m"))
    run()
    arrive(("o", "c", 2, False, None, False, None, None, 0, 0, None), ("o", "b", 3, None, None, True, 4, 4, 2, 0, "z"))
    fold = run()
    fold = run()
    rows = {r.repo_name: (r.repo_size, r.clone_successful, r.num_makefiles) for r in fold.state(fold.latest_version()).collect()}
    assert rows == {"a": (5, True, 1), "b": (10, True, 4), "c": (-1, False, 0)}
    assert tuple(fold.totals().first()) == (3, 5, 1)
    assert {r.library for r in fold.libraries().collect()} == {"m", "z"}


def test_stream_writes_what_a_batch_touches(spark, monkeypatch):
    from corpusflow.streaming import results

    monkeypatch.setattr(results, "WHOLE_EVERY", 3)
    base = working_path(spark, "stream")
    initial = spark.createDataFrame([("o", f"r{i}", 5, True, True, 1, 1) for i in range(1000)], REPO)
    schema = RESULT + ", funcs_matched bigint, without_ast bigint, library string"
    fold = results.ResultFold(spark, base, initial)
    for n in range(5):
        fold.apply(spark.createDataFrame([("o", f"r{n}", 1, True, 10 + n, True, 2, 2, 3, 1, "m"), ("o", f"new{n}", 2, True, 1, False, None, None, 0, 0, None)], schema), n)
    fold.apply(spark.createDataFrame([("o", "r4", 1, True, 77, True, 2, 2, 3, 1, "m")], schema), 4)  # the last batch once more
    written = {v: spark.read.parquet(f"{base}/state/v={v:012d}").count() for v in fold._versions("state")}
    assert written == {3: 1003, 4: 2, 5: 1}
    sizes = {r.repo_name: r.repo_size for r in fold.latest().collect()}
    assert len(sizes) == 1004 and [sizes[f"r{n}"] for n in range(6)] == [10, 11, 12, 13, 77, 5]


def test_bucketed_tables_read_one_folder_for_a_key(spark):
    import re

    from corpusflow.sources import writers

    path = working_path(spark, "lines")
    rows = spark.range(3000).selectExpr("md5(cast(id % 500 as string)) as sha", "id as line_pos", "if(id < 500, '', concat('{', id, '}')) as line")
    writers.decompiled_lines(rows, path, buckets=16)
    whole = readers.stored_lines(spark, path, buckets=16)
    assert whole.count() == 2500 and len({re.search("bucket=[0-9]+", f)[0] for f in whole.inputFiles()}) == 16
    sha = rows.first().sha
    one = readers.stored_lines(spark, path, sha, buckets=16)
    assert sorted(r.line for r in one.collect()) == sorted(r.line for r in whole.filter(F.col("sha") == sha).collect()) and one.count() == 5
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = \d+", one._jdf.queryExecution().executedPlan().toString())
    path = working_path(spark, "functions")
    writers.decompiled_functions(rows.selectExpr("sha", "concat('f', line_pos) as function", "'{\"a\": 1}' as ast", "line as raw_code"), path, buckets=4)
    assert readers.stored_functions(spark, path, buckets=4).count() == 3000
    assert {tuple(r)[:1] + (r.ast,) for r in readers.stored_functions(spark, path, sha, buckets=4).collect()} == {(sha, '{"a": 1}')}


def test_last_values_are_carried_across_ranges(spark):
    from corpusflow.operators.ordered import last_values

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        rows = [("hot" if i % 3 else f"k{i % 5}", i * 7 % 1009, None if i % 11 else i) for i in range(1000)]
        got = last_values(spark.createDataFrame(rows, "k string, at long, x long"), ["k"], ["at"], "x", "last").collect()
        expected = {}
        for k, at, x in sorted(rows, key=lambda r: r[:2]):
            expected[k, at] = x if x is not None else max(((a, v) for (kk, a), v in expected.items() if kk == k and v is not None), default=(0, None))[1]
        assert {(r.k, r.at): r["last"] for r in got} == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_callers_predicate_and_hash_may_be_vectorised(spark):
    import hashlib

    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    from corpusflow.operators import joins

    @pandas_udf("boolean")
    def wanted(directory: pd.Series, path: pd.Series) -> pd.Series:
        return path.str.endswith(".o") & (directory != "skip")

    @pandas_udf("string")
    def digest(directory: pd.Series, path: pd.Series) -> pd.Series:
        return (directory + "/" + path).map(lambda x: hashlib.md5(x.encode()).hexdigest())

    files = spark.createDataFrame([("d", "a.o"), ("d", "b.c"), ("skip", "c.o")], "directory string, path string")
    rows = joins.keep_files(files, wanted, digest).collect()
    assert [(r.directory, r.path, r.sha) for r in rows] == [("d", "a.o", hashlib.md5(b"d/a.o").hexdigest())]
    plain = joins.keep_files(files, lambda d, p: p.endswith(".o"), lambda d, p: F.md5(F.concat(d, p))).collect()
    assert {r.sha for r in plain} == {hashlib.md5(x).hexdigest() for x in (b"da.o", b"skipc.o")}


def test_written_tables_can_be_released(spark):
    from corpusflow.session import release, settle

    kept = settle(spark.range(5))
    assert kept.count() == 5 and release(spark) >= 1 and release(spark) == 0
    with pytest.raises(Exception, match="(?i)exist|missing|not find"):
        kept.collect()


def test_each_page_has_a_file_of_its_own(spark, tmp_path):
    from corpusflow.catalog import QUERIES

    rows = [(1, "a\nb"), (1, "c"), (65, "d"), (129, ""), (2, "e"), (None, "f")]
    spark.createDataFrame(rows, "page_id bigint, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = sorted((r.page_id or 0, r.length) for r in QUERIES["src08_file_inventory"](spark, str(tmp_path)).collect())
    assert found == sorted((i or 0, len(html) + 1) for i, html in rows)
    assert len({r.sha for r in QUERIES["src09_file_hashes"](spark, str(tmp_path)).collect()}) == len(rows)
    assert sorted(r.n_chars for r in QUERIES["src10_source_texts"](spark, str(tmp_path)).collect()) == sorted(len(html) + 1 for _, html in rows)


def test_files_are_listed_and_read_some_folders_at_a_time(spark, tmp_path, monkeypatch):
    for i in range(60):
        (tmp_path / f"f{i}").mkdir()
        (tmp_path / f"f{i}" / "a.txt").write_text("x" * (i + 1))
        (tmp_path / f"f{i}" / "b.bin").write_bytes(b"\xff")
    (tmp_path / ".hidden").mkdir()
    (tmp_path / ".hidden" / "c.txt").write_text("c")
    (tmp_path / "top.txt").write_text("top")
    monkeypatch.setattr(readers, "FILES_AT_ONCE", 16)
    steps = []

    def sizes(files):
        steps.append(files.count())
        return files.selectExpr("length(content) as n")

    assert sorted(r.n for r in readers.binary_files(spark, str(tmp_path), sizes).collect()) == sorted([*range(1, 61), *[1] * 60, 3])
    assert max(steps) <= 16 and sum(steps) == 121
    assert sorted(r.n for r in readers.source_files(spark, str(tmp_path), lambda texts: texts.selectExpr("length(code) as n")).collect()) == sorted([*range(1, 61), 3])
    found = {(r.dir, r.file, r.length) for r in readers.file_inventory(spark, str(tmp_path)).collect()}
    assert found == {(f"{tmp_path}/f{i}", *x) for i in range(60) for x in (("a.txt", i + 1), ("b.bin", 1))} | {(str(tmp_path), "top.txt", 3)}
    (tmp_path / "none").mkdir()
    assert readers.file_inventory(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(Exception, match="(?i)not_found|not exist"):
        readers.file_inventory(spark, f"{tmp_path}/missing")


def test_files_of_rows_are_written_evenly_and_without_checksums(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "FILES_PER_FOLDER", 50)
    rows = [(7 if i % 3 else i, "é" * (i % 5) + "\r\n") for i in range(400)] + [(None, "n"), (7, None), (-3, "")]
    expected = sorted((f"page={'__HIVE_DEFAULT_PARTITION__' if k is None else k}", (x or "").encode() + b"\n") for k, x in rows)
    for parts in (1, 8):  # dealt anew, and as they lie
        frame = spark.createDataFrame(rows, "page bigint, text string").coalesce(1).repartition(parts)
        for mounted in (True, False):
            path = tmp_path / f"{parts}-{mounted}"
            writers.file_per_row(frame, "page", "text", str(path), mounted)
            contents = readers.binary_files(spark, str(path), lambda files: files.selectExpr("regexp_extract(path, '(page=(-?[0-9]+|[A-Z_]+))[-/]([^/]*[.]txt)?', 1) as page", "content"))
            assert sorted((r.page, bytes(r.content)) for r in contents.collect()) == expected
        folders = [[f.name for f in folder.iterdir()] for folder in (tmp_path / f"{parts}-True").iterdir()]
        assert max(map(len, folders)) <= 60 and sum(map(len, folders)) == len(rows)
        assert all(n.endswith(".txt") and not n.startswith(".") for names in folders for n in names)  # no checksums


def test_folders_of_attempts_that_do_not_count_are_not_read(spark, tmp_path):
    import os

    path = tmp_path / "files"
    writers.file_per_row(spark.createDataFrame([(1, "a")], "page bigint, text string"), "page", "text", str(path))
    os.makedirs(path / ".lost")
    (path / ".lost" / "page=2-0.txt").write_text("b\n")
    assert [r.length for r in readers.file_inventory(spark, str(path)).collect()] == [2]


def test_pages_are_staged_without_a_process_for_each_file(spark, tmp_path):
    import glob

    from corpusflow.catalog.files import _page_files
    from corpusflow.catalog.registry import Views

    spark.createDataFrame([(i // 2, f"p{i}") for i in range(40)], "page_id bigint, html string").write.parquet(f"{tmp_path}/pages.parquet")
    path = _page_files(Views(spark, str(tmp_path))).removeprefix("file:")
    assert len(glob.glob(f"{path}/*/page_id=*.txt")) == 40 and not glob.glob(f"{path}/**/.*", recursive=True)
