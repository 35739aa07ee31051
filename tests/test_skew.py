"""A hot key is split across tasks by adaptive execution.

One account holds most of the lines.  With the skew thresholds lowered to
this test's scale and broadcasts disabled, the executed plan of every
"aggregate, then join back" step must show a skew-split sort-merge join.
"""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from yoyflow.operators.groups import distinct_indicator, group_flag
from yoyflow.operators.patch import update_from
from yoyflow.operators.temporal import first_event, year_offset_join_many

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own adaptive plan to its final form
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _lines(spark):
    hot = spark.range(40000).select(F.lit("HOT").alias("acct"), F.lit(2024).alias("fy"), (F.col("id") % 97).alias("v"))
    cold = spark.range(2000).select(
        F.concat(F.lit("a"), (F.col("id") % 200).cast("string")).alias("acct"), F.lit(2024).alias("fy"), F.col("id").alias("v")
    )
    return hot.unionByName(cold)


def test_snapshot_join_splits_hot_account(spark, skew_conf):
    lines = _lines(spark)
    snap = lines.select("acct").distinct().crossJoin(spark.createDataFrame([(2023,), (2024,), (2025,)], "fy int"))
    snap = snap.withColumn("t", F.length("acct"))
    out = year_offset_join_many(
        lines,
        [(snap, "fy", {-1: {"t_prev": "t"}, 0: {"t_now": "t"}}, "a"), (snap, "fy", {1: {"t_next": "t"}}, "b")],
        [("acct", "acct")], "fy",
    )
    assert "skew=true" in _final_plan(out)
    assert out.where("t_now IS NULL").count() == 0


def test_group_flag_splits_hot_group(spark, skew_conf):
    assert "skew=true" in _final_plan(group_flag(_lines(spark), ["acct", "fy"], {"n": F.count(F.lit(1))}))


def test_first_event_splits_hot_group(spark, skew_conf):
    assert "skew=true" in _final_plan(first_event(_lines(spark), ["acct"], "v", F.col("fy") == 2024, "first_v"))


def test_indicator_and_update_split_hot_key(spark, skew_conf):
    lines = _lines(spark)
    members = lines.select(F.col("acct").alias("m"), F.col("fy").alias("y"))
    assert "skew=true" in _final_plan(distinct_indicator(lines, members, ["acct", "fy"], ["m", "y"], "flag"))
    src = lines.groupBy("acct").agg(F.max("v").alias("mv"))
    assert "skew=true" in _final_plan(update_from(lines, src, ["acct"], {"v": "mv"}))


def test_anti_and_null_safe_joins_split_hot_key(spark, skew_conf):
    from yoyflow.operators.joins import hashed_join

    import tempfile

    path = tempfile.mkdtemp(prefix="yoyflow-skew-") + "/lines"
    _lines(spark).write.parquet(path)
    lines = spark.read.parquet(path)  # stored, so the optimizer cannot fold the hot key away
    current = lines.where(F.col("v") >= 100).select("acct", "fy").distinct()  # every account but the hot one
    anti = hashed_join(lines, current, ["acct", "fy"], "left_anti")
    assert "skew=true" in _final_plan(anti)
    assert anti.count() == 40000  # only the hot account has no counterpart
    counts = lines.groupBy(F.col("acct").alias("g")).agg(F.count(F.lit(1)).alias("n"))
    joined = hashed_join(lines, counts, [("acct", "g")], "left", null_safe=True)
    assert "skew=true" in _final_plan(joined)
    assert joined.where("acct = 'HOT'").select("n").distinct().collect()[0][0] == 40000


def _shuffle_rows(df, spark) -> list[int]:
    """Rows in each partition of the left input of the (single) join of ``df``, as its key deals them."""
    from pyspark.sql import functions as F

    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_null_keys_are_scattered(spark, skew_conf):
    """90 % of the keys are NULL: with a row id to scatter them, no partition holds much more than its share."""
    from yoyflow.operators.joins import hashed_join

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(20000).selectExpr("id", "case when id % 10 = 0 then concat('k', id % 500) end as k")
        dim = spark.range(500).selectExpr("concat('k', id) as dk", "id as v")
        plain, spread = (hashed_join(rows, dim, [("k", "dk")], scatter=s) for s in ((), ("id",)))
        assert max(_shuffle_rows(plain, spark)) > 18000
        assert max(_shuffle_rows(spread, spark)) < 3 * 20000 / 16
        again = hashed_join(spread, dim.withColumnRenamed("v", "w"), [("k", "dk")], scatter=("id",))  # a chain on one key
        assert max(_shuffle_rows(again, spark)) < 3 * 20000 / 16
        assert sorted(map(tuple, spread.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
        assert spread.where("v is not null").count() == rows.where("k is not null").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_pool_joins_deal_rows_without_subscription_by_their_id(spark):
    from yoyflow.plans import renewal_pool as rp
    from yoyflow.plans.registry import TEST_PARAMS, renewal_inputs
    from yoyflow.sources.adapters import SparkInputs

    pool = rp.build_pool(renewal_inputs(SparkInputs(spark, "/root/testdata/sf0.001")), TEST_PARAMS)
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    plan = pool._jdf.queryExecution().analyzed().toString()
    assert plan.count("xxhash64(SourceObjectSFID") >= 5
