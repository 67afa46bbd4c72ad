"""Physical-plan checks: broadcast lookup, one shuffle per fact with a
partial aggregate before it, no Python in the silver plans, pruned scans."""

from __future__ import annotations

from obslake.plans import catalog

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_plan_shape(spark):
    plan = _plan(catalog.fact_current_a(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    assert "partial_min_by" in plan
    # one shuffle of the measures; the dimension's own is below the broadcast
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.split("BroadcastExchange")[0].count("Exchange hashpartitioning") == 1
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert python_node not in plan


def test_forecast_single_generator_no_union(spark):
    plan = _plan(catalog.forecast_long(spark, SF_SMALL))
    assert "Union" not in plan and plan.count("Generate") == 1


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(catalog.dedupe_deterministic(spark, SF_SMALL))
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_alert_one_shuffle_no_join(spark):
    plan = _plan(catalog.failure_alert(spark, SF_SMALL))
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_candidates_pre_aggregate_before_shuffle(spark):
    plan = _plan(catalog.dim_candidates(spark, SF_SMALL))
    # each feed's rows are reduced map-side (partial min_by) before their
    # only shuffle; the full outer join then moves one row per place
    assert plan.count("partial_min_by") == 2
    assert "FullOuter" in plan


def test_silver_parses_each_payload_once(spark):
    from pyspark import StorageLevel
    from obslake import specs
    from obslake.operators import parse
    env = catalog.landed(spark, SF_SMALL)
    cached = parse.parse_payload(parse.route_feed(env, specs.AIR_QUALITY), specs.AIR_QUALITY) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    try:
        valid = parse.validate(cached, specs.AIR_QUALITY)
        valid.count()
        plan = _plan(valid)
        assert "InMemoryTableScan" in plan and plan.count("from_json") == 1
    finally:
        cached.unpersist()


def test_metrics_one_pass_over_the_envelope(spark):
    plan = _plan(catalog.run_metrics(spark, SF_SMALL))  # not executed: one plan, no AQE split
    envelope_scans = [line for line in plan.splitlines()
                      if "FileScan parquet" in line and "payload" in line]
    assert len(envelope_scans) == 1 and "Union" not in plan


def test_silver_scans_the_hour_once_for_all_feeds(spark):
    from pyspark import StorageLevel
    from obslake import specs
    from obslake.operators import parse
    feeds = (specs.AIR_QUALITY, specs.WEATHER)
    both = parse.parse_payloads(catalog.landed(spark, SF_SMALL), feeds) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for f in feeds:
            valid = parse.validate(parse.feed_rows(both, f), f)
            valid.count()
            plan = _plan(valid)
            # one scan and one from_json per feed, both inside the cached plan
            assert "InMemoryTableScan" in plan
            assert plan.count("FileScan") == 1 and plan.count("from_json") == len(feeds)
    finally:
        both.unpersist()
