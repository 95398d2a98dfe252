"""Shapes a plan must and must not have to survive at scale."""

import pytest

from tallyweek.workloads.queries import QUERIES


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(params=["10MB", "-1"], ids=["broadcast", "shuffle"])
def threshold(spark, request):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


#: These write files and read them back.
WRITERS = {
    "sink_national", "sink_states", "scan_csv", "population_dim", "flagship_landing", "flagship_landing_counts",
    "rejected_rows", "malformed_lines", "recompile_revised", "sink_empty_extract",
}
LAZY = sorted(set(QUERIES) - WRITERS)


@pytest.mark.parametrize("name", LAZY)
def test_building_calls_no_action(spark, sf_dir, name, monkeypatch):
    def refuse(*_args, **_kwargs):
        raise AssertionError("an action while a query is built")

    for action in ("collect", "count", "first", "head", "isEmpty", "toPandas", "take", "checkpoint", "localCheckpoint"):
        monkeypatch.setattr(type(spark.range(1)), action, refuse)
    monkeypatch.setattr(type(spark.range(1)), "write", property(refuse))
    QUERIES[name](spark, sf_dir)


@pytest.mark.parametrize("name", LAZY)
def test_no_plan_to_regret(spark, sf_dir, name, threshold):
    plan = physical(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroupsIn"):
        assert bad not in plan, f"{bad} in {name}"
    for line in plan.splitlines():
        if "- Window [" in line:
            # the partition list comes before the order list and must not be empty
            assert "], [], [" not in line, line
    if threshold == "-1":
        assert "BroadcastExchange" not in plan, "a broadcast that ignores its size limit"


@pytest.mark.parametrize("name", ["summary_stats", "national_rollup", "first_per_entity", "yearly_rate"])
def test_rows_are_reduced_by_hash_before_any_sort(spark, sf_dir, name):
    """The first aggregate above the counted facts is a hash aggregate."""
    lines = physical(QUERIES[name](spark, sf_dir)).split("== Initial Plan ==")[0].splitlines()
    aggregates = [line for line in lines if "Aggregate(" in line]
    sorted_ = [at for at, line in enumerate(aggregates) if "SortAggregate" in line or "ObjectHash" in line]
    # top down: below every sort or object aggregate is a hash aggregate that is not the count of the facts
    hashed = [at for at, line in enumerate(aggregates) if "HashAggregate" in line and "ObjectHash" not in line and "saturday" not in line]
    assert not sorted_ or any(at > max(sorted_) for at in hashed)


def test_dedup_limits_rows_before_the_shuffle(spark, sf_dir):
    plan = physical(QUERIES["dedup_best"](spark, sf_dir))
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name, scans", [("series_dev_avg", 1), ("metric_excess", 1), ("series_per_100k", 1), ("validate_yoy", 1)])
def test_orders_are_read_once(spark, sf_dir, name, scans):
    plan = physical(QUERIES[name](spark, sf_dir)).split("== Initial Plan ==")[-1]
    assert plan.count("FileScan parquet [o_custkey") == scans


def test_hot_customer_is_split(spark, sf_dir, tmp_path):
    """A customer with a third of all orders does not end up in one task."""
    for name in ("customer", "nation"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.range(0, 600_000, 1, 8).selectExpr(
        "id AS o_orderkey",
        "CASE WHEN id % 3 = 0 THEN 7 ELSE 1 + abs(xxhash64(id)) % 1000 END AS o_custkey",
        "cast(date_add(date'1995-01-01', cast(abs(xxhash64(id, 1)) % 2000 AS int)) AS timestamp_ntz) AS o_orderdate",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        frame = QUERIES["metric_total"](spark, str(tmp_path))
        assert frame.collect()[0][0] == 600_000
        assert "SortMergeJoin(skew=true)" in physical(frame)
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    plan = physical(QUERIES["series_raw"](spark, sf_dir))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    plan = physical(QUERIES["dataset_info"](spark, sf_dir))
    assert "o_totalprice" not in plan


def test_skewed_state_is_combined_before_the_shuffle(spark):
    from tallyweek.operators.fold import fold_entities
    from tallyweek.operators.series import series

    rows = spark.range(0, 200_000, 1, 8).selectExpr(
        "2020 AS year", "cast(id % 3 AS int) AS week", "cast(id % 3 AS int) AS mmwr_week",
        "CASE WHEN id % 3 < 2 THEN 'New York' ELSE 'New York City' END AS state", "1.0D AS deaths",
    )
    folded = fold_entities(rows, how="sum")
    assert {r.deaths for r in folded.collect()} == {66667.0, 66666.0}
    assert "partial_sum" in physical(folded) and "partial_sum" in physical(series(rows, "raw"))
