"""Plan shape: the protection projection adds no shuffle and no Python node,
and filters/column pruning reach the scan."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from veilspark.operators.protect import apply_policy, apply_policy_json
from veilspark.plans import policies as P


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_typed_policy_is_one_narrow_stage(spark):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet").where(F.col("c_nationkey") == 3)
    p = plan(apply_policy(c, P.CUSTOMER_COLUMNS, id_col="c_custkey"))
    assert "Exchange" not in p and "Python" not in p
    assert "PushedFilters: [IsNotNull(c_nationkey), EqualTo(c_nationkey,3)]" in p
    # c_acctbal is redacted to a NULL constant, so it is not even read
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int>" in p
    assert "WholeStageCodegen" in p or "*(" in p


def test_json_policy_is_one_narrow_stage(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select(
        F.to_json(F.struct(F.col("c_custkey").alias("id"), "c_name", "c_nationkey")).alias("value"))
    p = plan(apply_policy_json(docs, P.CUSTOMER_JSON))
    assert "Exchange" not in p and "Python" not in p
    assert p.count("JsonToStructsEvaluator") + p.count("from_json(") == 1, p  # the record's text is parsed once


def test_random_text_projection_is_separate(spark):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    p = plan(apply_policy(c, P.RANDOMIZE, id_col="c_custkey"))
    assert "Exchange" not in p and "Python" not in p


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _partial_before_exchange(p: str, fn: str) -> bool:
    # the executed (AQE) plan lists the final aggregate above the exchange and the partial one below it
    return f"partial_{fn}" in p and "Exchange hashpartitioning" in p and p.index("Exchange hashpartitioning") < p.index(f"partial_{fn}")


def test_reports_aggregate_map_side(spark):
    from veilspark.operators import drift, lake, validate
    from veilspark.plans import inputs

    events = inputs.event_json(spark, SF_SMALL)
    assert _partial_before_exchange(executed(drift.drift_report(events, P.EVENT_DECLARED)), "count")
    assert _partial_before_exchange(executed(drift.type_profile(events)), "count")
    checked = validate.validate_fields(inputs.customer_json(spark, SF_SMALL), P.CUSTOMER_VALIDATION)
    assert _partial_before_exchange(executed(validate.validation_summary(checked)), "count")
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert _partial_before_exchange(executed(lake.latest_per_key(e, "user_id", ["ts", "event_id"])), "max_by")


def test_inventory_broadcasts_rules(spark):
    from veilspark.operators import drift
    from veilspark.plans import inputs

    p = executed(drift.field_inventory(inputs.event_json(spark, SF_SMALL), P.EVENT_JSON))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_merge_prunes_days_and_rebalances(spark, tmp_dir):
    from veilspark.operators import lake

    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    path = f"{tmp_dir}/t"
    lake.write_daily(lake.add_time_columns(e, "ts").drop(lake.PROCESSING_TS), path)
    existing = lake.read_table(spark, path)
    upd = lake.add_time_columns(e.where("ts >= '2024-01-29'"), "ts").drop(lake.PROCESSING_TS)
    cur = existing.join(upd.select(lake.PARTITION_COL).distinct(), lake.PARTITION_COL, "left_semi")
    assert "dynamicpruning" in executed(cur)
    logical = lake.rebalance_days(upd)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in logical


def test_inventory_without_broadcast_above_the_bound(spark, monkeypatch):
    from veilspark.operators import drift
    from veilspark.plans import inputs

    events = inputs.event_json(spark, SF_SMALL)
    want = sorted(tuple(r) for r in drift.field_inventory(events, P.EVENT_JSON).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(drift, "MAX_BROADCAST_RULES", 0)
        df = drift.field_inventory(events, P.EVENT_JSON)
        p = executed(df)
        assert "BroadcastHashJoin" not in p and ("SortMergeJoin" in p or "ShuffledHashJoin" in p)
        assert sorted(tuple(r) for r in df.collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
