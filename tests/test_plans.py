"""Plan shape: the properties the design depends on at scale."""

import __spark_entry__ as E

Q = E.queries()


def plan(spark, name, sf):
    return Q[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_theta_join_has_no_nested_loop(spark, small_dir):
    assert "BroadcastNestedLoopJoin" not in plan(spark, "j_theta", small_dir)


def test_workdays_have_no_python_udf(spark, small_dir):
    p = plan(spark, "t_01_workdays", small_dir)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_aligned_explode_is_one_generate(spark, small_dir):
    assert plan(spark, "r_11_explode_aligned", small_dir).count("Generate") == 1


def test_survivorship_single_aggregate_no_window(spark, small_dir):
    p = plan(spark, "a_12_survivorship", small_dir)
    assert "Window" not in p


def test_dedupe_uses_partial_group_limit(spark, small_dir):
    df = Q["w_01_dedupe_latest"](spark, small_dir)
    txt = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in txt


def test_snapshot_reads_prune_partitions(spark, small_dir):
    p = plan(spark, "s_05_scan_asof_snapshot", small_dir)
    assert "PartitionFilters: [isnotnull(load_date" in p or "PartitionFilters: [" in p
    assert "PartitionFilters: []" not in p


def test_filters_and_columns_pushed_to_scan(spark, small_dir):
    p = plan(spark, "p_02_filter", small_dir)
    assert "PushedFilters: [IsNotNull(l_quantity)" in p
    assert "ReadSchema: struct<l_orderkey:bigint," in p


def test_no_nested_loops_products_or_python_in_any_plan(spark, small_dir):
    bad = []
    for name, fn in Q.items():
        p = fn(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
        for tok in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
            if tok in p:
                bad.append((name, tok))
    assert bad == []


def test_survivorship_is_one_shuffle(spark, small_dir):
    p = plan(spark, "a_12_survivorship", small_dir)
    assert p.count("Exchange hashpartitioning") == 1


def test_snapshot_range_prunes_partitions(spark, small_dir):
    p = plan(spark, "s_06_scan_snapshot_range", small_dir)
    assert "PartitionFilters: [" in p and "PartitionFilters: []" not in p
