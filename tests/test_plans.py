"""The physical plans are the ones wanted at scale."""

import re

from pyspark.sql import functions as F

from corpusflow.fixtures import view
from corpusflow.operators import joins, state, tokens
from corpusflow.session import settle
from tests.conftest import SF_DIR


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_tokens_move_the_text_once_and_sort_once(spark):
    files = view(spark, SF_DIR, "c_source").select("file_id", "code")
    text = plan(tokens.spans(tokens.tokens(files, "file_id"), "file_id"))
    assert text.count("Exchange hashpartitioning") == 1 and "PythonUDF" not in text
    assert len(re.findall(r"Sort \[file_id", text)) == 1 and text.count("+- Window") >= 4


def test_only_needed_columns_and_filters_reach_the_scan(spark):
    stored = settle(view(spark, SF_DIR, "binaries"))
    text = plan(state.binaries_of(stored, "c1", "r1").select("sha"))
    assert "EqualTo(repo_owner,c1)" in text  # the list is cut after a few filters
    totals = plan(settle(view(spark, SF_DIR, "match_func")).agg(F.sum("funcs_matched")))
    assert re.search(r"ReadSchema: struct<funcs_matched:bigint>", totals)


def test_claims_are_reduced_before_the_shuffle(spark):
    text = plan(joins.first_claims(view(spark, SF_DIR, "makefile_binary")))
    assert text.index("partial_min_by") > text.index("Exchange hashpartitioning")  # below it in the tree


def test_no_query_uses_a_cross_product(spark):
    from corpusflow.catalog import QUERIES

    for name in ["jn11_package_candidates", "win03_best_packages", "jn10_token_positions", "jn08_run_comparison", "jn12_renamed_variables"]:
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_filters_reach_the_scan_at_any_size(spark):
    from corpusflow.catalog import QUERIES

    for name in ["fil03_archive_size", "fil05_eligible_repos"]:
        for folder in [SF_DIR, "/root/testdata/sf0.1"]:
            text = plan(QUERIES[name](spark, folder))
            assert "PushedFilters: [Is" in text and "Exchange" not in text, (name, folder)


def test_running_totals_read_their_input_once(spark):
    from corpusflow.catalog import QUERIES

    for name in ["ord03_running_totals", "win01_time_budget", "win05_variable_ids"]:
        text = plan(QUERIES[name](spark, SF_DIR))
        assert text.count("FileScan parquet") <= 4 and "lineitem" not in text and "orders" not in text, name  # the dealt rows, for sums and totals


def test_summary_is_one_aggregate(spark):
    from corpusflow.catalog import QUERIES

    text = plan(QUERIES["agg06_compile_summary"](spark, SF_DIR))
    assert "Join" not in text.split("== Initial Plan ==")[-1] and text.split("== Initial Plan ==")[-1].count("FileScan") == 1


def test_trees_are_folded_without_pairs_of_ancestors(spark):
    from corpusflow.operators import trees

    rows = trees.nodes(view(spark, SF_DIR, "c_ast"), ["func_id"], "ast")
    folded = plan(trees.fold(rows, ["func_id"], {"n": ("sum", F.lit(1))}))
    assert "CartesianProduct" not in folded and "NestedLoop" not in folded


def test_trees_stay_in_the_jvm_and_are_shuffled_once(spark):
    from corpusflow.catalog import QUERIES

    for name in ["js02_c_nodes", "js02_decompiler_nodes", "js03_subtree_folds", "js03_ordered_folds", "js04_rebuilt_trees", "udf02_custom_fold", "udf02_struct_fold"]:
        text = plan(QUERIES[name](spark, SF_DIR)).split("== Initial Plan ==")[-1]
        assert not any(node in text for node in ("Python", "Pandas", "Arrow", "Join")) and text.count("Exchange") == 1 and text.count("FileScan") == 1, name


def test_trees_are_gathered_once_for_a_fold(spark):
    """Pieces to nodes, nodes to paths and nodes to folds: three groupings, each in two steps."""
    from corpusflow.catalog import QUERIES

    for name in ["js03_ordered_folds", "udf02_struct_fold"]:
        text = plan(QUERIES[name](spark, SF_DIR)).split("== Initial Plan ==")[-1]
        assert text.count("ObjectHashAggregate") == 6 and "SortAggregate" not in text, name


def test_estimated_count_reads_no_column(spark):
    from corpusflow.catalog import QUERIES

    frame = QUERIES["agg04_estimated_count"](spark, SF_DIR)
    assert "PushedAggregation: [COUNT(*)]" in plan(frame)


def test_costly_patterns_do_not_run_in_one_task(spark):
    from corpusflow.catalog import QUERIES

    for name in ["txt05_variables", "txt08_full_names", "txt19_compile_commands", "js01_decoded_lines", "agg07_libraries_per_repo", "agg15_changed_repos", "agg16_log_snapshot"]:
        assert "REPARTITION_BY_NUM" in plan(QUERIES[name](spark, SF_DIR)), name


def test_best_packages_are_found_before_libraries_join(spark):
    """A name of one letter or of dots reads one row for each task and pattern, not one for each package."""
    from corpusflow.operators import libraries

    packages = spark.range(20_000).selectExpr("concat('lib', 'm', id % 7, 'x', id, '-dev') as pkg")
    libs = spark.createDataFrame([("m",), ("..",), ("nothing",)], "lib string")
    found = {(r.lib, r.priority): r.pkg for r in libraries.candidates(libs, packages).collect()}
    assert found["m", 5] == "libm0x0-dev" and found["..", 4] == "libm0x0-dev" and not any(k[0] == "nothing" for k in found)
    text = plan(libraries.candidates(libs, packages)).split("== Initial Plan ==")[-1]
    shuffled = [line for line in text.split("\n") if "Exchange hashpartitioning" in line and "pkg" in line]
    assert len(shuffled) <= 2 and all("kind" not in line.split("pkg")[0] for line in shuffled), text  # packages move once, by their name


def test_probes_of_one_file_spread(spark):
    rows = spark.range(20_000).selectExpr("1 as file", "id as line", "1 as col", "id as pos", "'x' as value")
    probes = spark.range(20_000).selectExpr("1 as file", "id as line", "5 as col", "id as probe")
    found = tokens.token_at(rows, probes, "file", "probe")
    assert found.filter("line > 0 and token_pos = line").count() == 19_999
    windows = [line for line in plan(found).split("\n") if "Window [last(pos" in line]
    assert windows and all("_part" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in windows)  # by range, not by file


def test_known_functions_are_not_sent_whole_to_the_tasks(spark):
    from corpusflow.operators import matching

    known = settle(spark.range(40).selectExpr("cast(id % 20 as string) as sha", "concat('f', id) as func_name"))
    lines = spark.range(4000).selectExpr("cast(id % 25 as string) as sha", "concat('f', id % 100) as func_name", "id as line_pos", "id")
    found = matching.lines_of_known_functions(lines, known)
    text = plan(found)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert {r.id for r in found.collect()} == {i for i in range(4000) if i % 100 < 40 and i % 25 == i % 100 % 20}
    near = matching.possibly_known(lines, known, ["sha", "func_name"])
    assert found.count() == 800 <= near.count() < 900  # nearly all others go before the shuffle
    assert matching.lines_of_known_functions(lines, known.filter("false")).isEmpty()


def test_makefile_lists_are_not_moved_for_their_counts(spark):
    from corpusflow.catalog import QUERIES

    for name in ["ups02_update_report", "ups02_update_makefiles"]:
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "max_by(" in text and not re.search(r"max_by\([^)]*makefiles", text), name


def test_result_lists_are_counted_before_the_join(spark):
    from corpusflow.catalog import QUERIES

    text = plan(QUERIES["src11_tolerant_results"](spark, SF_DIR))
    assert text.index("size(makefiles") > text.index("Join")  # below it in the tree


def test_staged_and_stored_lists_are_compressed(spark, tmp_path):
    import os

    from corpusflow.catalog.files import staged_parquet
    from corpusflow.catalog.registry import Views
    from corpusflow.sources import writers

    hashes = spark.range(60000, numPartitions=1).selectExpr("transform(sequence(1, 4), i -> sha2(cast(pmod(hash(id, i), 5000) as string), 256)) as sha256")
    staged = spark.read.parquet(staged_parquet(Views(spark, SF_DIR), "hashes", hashes))
    assert all(".zstd." in f for f in staged.inputFiles())
    assert sum(os.path.getsize(f.removeprefix("file:")) if not f.startswith("file://") else os.path.getsize(f[7:]) for f in staged.inputFiles()) < 240000 * 8
    rows = spark.range(3000).selectExpr("md5(cast(id as string)) as sha", "concat('f', id) as function", "'{}' as ast", "'' as raw_code")
    writers.decompiled_functions(rows, f"{tmp_path}/f", buckets=4, spread=3)
    files = [n for _, _, found in os.walk(f"{tmp_path}/f") for n in found if n.startswith("part-")]
    assert len(files) == 12 and all(n.endswith(".json.gz") for n in files)


def test_uses_are_dealt_by_variable_once(spark):
    from corpusflow.catalog import QUERIES

    text = plan(QUERIES["jn12_renamed_variables"](spark, SF_DIR))
    assert len(re.findall(r"Exchange hashpartitioning\(binary_id#\d+L?, func_id", text)) == 2  # of both sides


def test_last_values_of_fixed_width_need_no_sort(spark):
    from corpusflow.operators.ordered import latest

    rows = spark.createDataFrame([(1, 5, 2, True), (1, 7, None, None), (2, 1, 3, False), (2, None, 4, True), (3, None, 9, True)], "k long, at long, n long, ok boolean")
    found = latest(rows, ["k"], F.col("at"), ["n", "ok"])
    assert "SortAggregate" not in plan(found)
    assert sorted(map(tuple, found.collect())) == [(1, None, None), (2, 3, False), (3, None, None)]
