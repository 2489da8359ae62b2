"""Plan shape: pruning, pushdown, no repeated subplans, map-side limits, entry contract."""

import importlib.util
import os

from pipewright import registry

from .conftest import SF001


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_scans_each_input_a_bounded_number_of_times(spark):
    p = plan_of(registry.queries()["pipeline_outcome"](spark, SF001))
    # current deals, anchor snapshot, change log: no set is recomputed per consumer
    assert p.count("FileScan parquet") <= 20
    assert p.count("Exchange hashpartitioning") <= 8


def test_scans_read_only_needed_columns(spark):
    p = plan_of(registry.queries()["renewal_scorecard"](spark, SF001))
    line = [x for x in p.splitlines() if "FileScan parquet" in x and "orders.parquet" in x][0]
    assert "o_comment" not in line and "ReadSchema: struct<o_orderkey" in line


def test_top_deals_limit_is_applied_before_the_shuffle(spark):
    p = plan_of(registry.queries()["top_deals"](spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_entry_contract(spark):
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0
    assert "Coverage_of_Closed_Won" in df.columns
    assert set(mod.oracle_sql()) <= set(mod.queries())


def test_no_nested_loop_cartesian_or_python_in_any_plan(spark):
    for name, job in registry.queries().items():
        p = plan_of(job(spark, SF001))
        for bad in ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"]:
            assert bad not in p, (name, bad)


def _without_broadcast(spark, make):
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, "-1")
    try:
        return plan_of(make())
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)


def test_deals_are_never_exchanged_on_the_owner(spark):
    for name in ["pipeline_outcome", "coverage_by_region", "renewal_scorecard", "opps_enriched", "team_velocity", "rep_velocity",
                 "ingest_converted", "movement_seed", "v2_starting_pipeline"]:
        p = _without_broadcast(spark, lambda: registry.queries()[name](spark, SF001))
        assert not [x for x in p.splitlines() if "Exchange hashpartitioning(OwnerId" in x], name


def test_salted_lookup_equals_the_broadcast_one(spark):
    from pyspark.sql import functions as F

    from pipewright.operators import joins
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 10 < 6, F.lit(3)).when(F.col("id") % 7 > 0, F.col("id") % 50).alias("k"))
    dim = spark.range(40).select(F.col("id").alias("d"), (F.col("id") * 2).alias("v"))
    small, large = (joins.lookup(df, dim, "k", "d", F.col("id"), limit=n) for n in (40, 39))
    assert "BroadcastHashJoin" in plan_of(small)
    p = _without_broadcast(spark, lambda: joins.lookup(df, dim, "k", "d", F.col("id"), limit=39))
    assert "SortMergeJoin [k" in p and "__salt" in p
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect())) and large.count() == 1000


def test_quarter_filter_stands_below_the_first_exchange(spark):
    """Deals closing at another time are not exchanged with those of the quarter, and a set reads what it needs."""
    for name in ["total_opps", "won_by_category"]:
        p = plan_of(registry.queries()[name](spark, SF001))
        scans = [x for x in p.splitlines() if "FileScan parquet" in x and "orders.parquet" in x]
        assert len(scans) == 1, (name, scans)  # no snapshot and no change log: they are derived from orders too
    for name in ["pulled_in", "new_pipe", "ghost_found"]:
        lines = plan_of(registry.queries()[name](spark, SF001)).splitlines()
        found = [i for i, x in enumerate(lines) if "Exchange hashpartitioning(Id" in x]
        assert len(found) == 2, name  # the deals and the anchor snapshot
        for i in found:
            scan = next(j for j in range(i, len(lines)) if "orders.parquet" in lines[j])
            below = "\n".join(lines[i:scan + 1])
            assert "1998-07-01" in below and "1998-10-0" in below, (name, below)
        deals = [x for x in lines if "orders.parquet" in x and "o_orderstatus" in x]
        assert len(deals) == 1 and "o_orderdate" in deals[0].partition("PushedFilters")[2].partition("ReadSchema")[0], (name, deals)


def test_team_velocity_reads_deals_once_and_shuffles_once(spark):
    p = plan_of(registry.queries()["team_velocity"](spark, SF001))
    assert len([x for x in p.splitlines() if "FileScan parquet" in x and "orders.parquet" in x]) == 1
    assert p.count("Exchange hashpartitioning(Opp_Owner_Manager") == 1 and "SortMergeJoin [Opp_Owner_Manager" not in p


def test_a_broken_corpus_package_leaves_the_other_queries(tmp_path):
    """An import that fails inside the corpus package, or an empty folder of its name, takes away its queries only."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name, broken in [("missing", "raise ImportError('no such library')\n"), ("empty", None)]:
        d = tmp_path / name
        d.mkdir()
        os.symlink(os.path.join(root, "__spark_entry__.py"), d / "__spark_entry__.py")
        os.makedirs(d / "pipewright" / "llm")
        for f in os.listdir(os.path.join(root, "pipewright")):
            if f != "llm":
                os.symlink(os.path.join(root, "pipewright", f), d / "pipewright" / f)
        if broken:
            (d / "pipewright" / "llm" / "__init__.py").write_text(broken)
        code = f"import importlib.util as u; s = u.spec_from_file_location('e', {str(d / '__spark_entry__.py')!r}); m = u.module_from_spec(s)\n" \
               f"import sys; sys.path.insert(0, {str(d)!r}); m.__dict__['__file__'] = {str(d / '__spark_entry__.py')!r}\n" \
               "s.loader.exec_module(m); print(len(m.queries()), any(q.startswith('op') and q[2].isdigit() for q in m.queries()))"
        out = subprocess.run([sys.executable, "-c", code], cwd=d, capture_output=True, text=True, timeout=120)
        assert out.stdout.split() == [str(len(registry.queries())), "False"], out.stderr[-1500:]


def test_a_revert_holds_no_sort_buffers_of_its_merge(spark):
    """Each sort of a stage holds its part of the table in the same task: those of the merge ended with its written result."""
    for name in ["reverted_accounts", "revert_outcomes", "reverted_after_edits"]:
        p = _without_broadcast(spark, lambda: registry.queries()[name](spark, SF001))
        assert p.count("Sort [") <= 8 and "customer.parquet" in p, (name, p.count("Sort ["))
