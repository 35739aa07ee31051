"""Readers, sinks, the runner and the code tables' widths."""

import pytest
from pyspark.sql import functions as F

from yoyflow.functions.text import spelled
from yoyflow.operators.lookup import BROADCAST_ROWS, lookup_by_code
from yoyflow.params import RunParams
from yoyflow.plans import run as runner
from yoyflow.sources import codetables
from yoyflow.sources.adapters import SparkInputs
from yoyflow.sources.io import read_input, write_extract, write_output, write_pool

SF = "/root/testdata/sf0.001"


def test_years_of_several_runs_share_a_folder(spark, tmp_path):
    out = f"{tmp_path}/extract"
    for year, n in ((2023, 5), (2024, 7), (2023, 3)):
        write_extract(spark.range(n).select("id", F.lit(year).alias("FiscalYear")), out)
    assert {r.FiscalYear: r["count"] for r in spark.read.parquet(out).groupBy("FiscalYear").count().collect()} == {2023: 3, 2024: 7}
    pool = f"{tmp_path}/pool"
    for year in (2022, 2025):
        write_pool(spark.range(4).select("id", F.lit(year).alias("PoolYear_FY")), pool)
    assert spark.read.parquet(pool).count() == 8
    plain = f"{tmp_path}/plain"
    for n in (5, 2):
        write_output(spark.range(n), plain)
    assert read_input(spark, plain).count() == 2


def test_inputs_keep_their_splits_unless_told(spark, tmp_path):
    path = f"{tmp_path}/in"
    spark.range(100).coalesce(1).write.parquet(path)
    assert read_input(spark, path).rdd.getNumPartitions() == 1
    assert read_input(spark, path, partitions=5).rdd.getNumPartitions() == 5


def test_long_code_lists_are_joined_without_a_hint(spark):
    rows = [(str(i),) for i in range(BROADCAST_ROWS + 1)]
    df = spark.createDataFrame([("7",), ("x",)], "k string")
    schema = spark.createDataFrame([], "code string").schema
    out = lookup_by_code(df, F.col("k"), rows, schema, "code")
    assert sorted((r.k, r.code) for r in out.collect()) == [("7", "7"), ("x", None)]
    assert "ResolvedHint" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_code_tables_at_both_widths(spark):
    for width, job in ((2, "12324" + "39"), (4, "12324" + "1139")):
        rows = codetables.campaign_group_rows(width)
        out = lookup_by_code(spark.createDataFrame([(job,)], "j string"), F.right("j", F.lit(width)), rows, codetables.CAMPAIGN_GROUPS_SCHEMA, "lk_code")
        assert out.first().lk_alr_group == "Digital"
    with pytest.raises(ValueError, match="not unique"):
        codetables.campaign_group_rows(1)
    assert RunParams(code_width=4, discount_code="1199").code_width == 4


def test_spelled_follows_the_sources_comparison(spark):
    df = spark.createDataFrame([("cross-SELL  ",), ("Cross-sell",), ("other ",), (None,)], "x string")
    assert [r[0] for r in df.select(spelled("x", ["Cross-sell", "Up-sell"])).collect()] == ["Cross-sell", "Cross-sell", "other", None]


def test_runner_writes_the_job(spark, tmp_path, monkeypatch, capsys):
    x, args = SparkInputs(spark, SF), []
    from yoyflow.plans.registry_extract import EXTRACT_ADAPTERS

    for name in EXTRACT_ADAPTERS:
        x[name].write.parquet(f"{tmp_path}/{name}")
        args += ["--input", f"{name.removeprefix('x_')}={tmp_path}/{name}"]
    out = f"{tmp_path}/out"
    for year in ("1998", "1997"):
        runner.main(["extract", *args, "--output", out, "--control-year", year, "--as-of", "1998-12-15 00:00:00"])
    got = spark.read.parquet(out)
    assert {r.FiscalYear for r in got.select("FiscalYear").distinct().collect()} == {1997, 1998}
    assert "as of 1998-12-15" in capsys.readouterr().out
    with pytest.raises(SystemExit):  # no default for the cut-off
        runner.main(["extract", *args, "--output", out, "--control-year", "1998"])
    with pytest.raises(SystemExit):
        runner.main(["extract", *args, "--output", out, "--control-year", "1998", "--as-of", "now", "--on-duplicate", "smallest"])


def test_discount_units_by_code_alone(spark):
    from yoyflow.plans import revenue_extract as rx
    from yoyflow.plans.registry_extract import extract_inputs

    def counts(test):
        params = RunParams(control_year=1998, as_of="1998-12-15 00:00:00", discount_test=test)
        pool = rx.stages(extract_inputs(SparkInputs(spark, SF)), params).pool
        return pool.agg(F.sum("PriorNonDiscount_Count"), F.count("*")).first()

    text, code = counts("text"), counts("code")
    assert text[1] == code[1] and text[0] <= code[0]  # names that hold the code no longer count as discounts
    with pytest.raises(ValueError, match="discount_test"):
        RunParams(discount_test="name")


@pytest.mark.parametrize("as_table", [False, True])
def test_rerun_leaves_no_rows_of_a_year_that_is_empty_now(spark, tmp_path, as_table):
    from yoyflow.sources.io import write_output

    where = "years_of_a_run" if as_table else f"{tmp_path}/out"
    read = lambda: {(r["y"], r["v"]) for r in (spark.table(where) if as_table else spark.read.parquet(where)).collect()}
    rows = lambda *r: spark.createDataFrame(list(r), "v string, y int")
    try:
        write_output(rows(("a", 2022), ("b", 2023), ("c", 2024)), where, "y", scope=[2022, 2023, 2024])
        write_output(rows(("d", 2024)), where, "y", scope=[2023, 2024])  # 2023 has no rows any more, 2022 is another run's
        if as_table:
            spark.catalog.refreshTable(where)
        assert read() == {(2022, "a"), (2024, "d")}
        with pytest.raises(ValueError, match="outside"):
            write_output(rows(("e", 2030)), where, "y", scope=[2024])
        assert read() == {(2022, "a"), (2024, "d")}
        write_output(rows(("x", 1)).where("false"), where, "y", scope=[2024])
        if as_table:
            spark.catalog.refreshTable(where)
        assert read() == {(2022, "a")}
    finally:
        if as_table:
            spark.sql(f"DROP TABLE IF EXISTS {where}")
