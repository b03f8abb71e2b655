"""The plans at scale: what is read, what is shuffled, and that no row leaves the JVM."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from acceptance import CASES
from solvind.functions.calendar import add_time_parts
from solvind.operators import append, pruning
from solvind.operators.dedup import dedup
from solvind.operators.layout import gather_partitions, stage, write_table
from solvind.operators.ranking import top_bottom_n
from solvind.operators.retention import keep
from solvind.plans import gold, refresh, reports
from solvind.schemas import SILVER
from solvind.sources import read_gold_normalised, read_table
from solvind.streaming.ingest import landing_rows, quarantine_rows
from tests.support import epoch, silver_rows

PACKAGE = Path(__file__).resolve().parent.parent / "solvind"
# The training-data operators have rules and tests of their own.
LIBRARY = [path for path in PACKAGE.rglob("*.py") if "llm" not in path.parts]


def plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    rows = silver_rows(spark, *({"city": c, "dt": epoch(y, m, 1)} for c in ("A", "B") for y in (2024, 2025) for m in (1, 2)))
    write_table(rows, root + "/silver", ["city"])
    write_table(add_time_parts(rows).select(*SILVER.fieldNames(), "year", "month"), root + "/monthly", ["city", "year", "month"])
    gold.write_gold(rows, root + "/gold")
    return root


def silver(spark, stored):
    return read_table(spark, stored + "/silver", SILVER)


def test_no_python_in_any_table_plan(spark, stored):
    frames = gold.gold_frames(silver(spark, stored))
    for name, frame in frames.items():
        text = plan(frame)
        assert "Python" not in text and "BatchEvalPython" not in text, name
        assert text.count("Exchange hashpartitioning") <= 2, name


def test_solar_reads_five_columns_and_shuffles_partial_sums(spark, stored):
    text = plan(gold.potencial_solar(silver(spark, stored)))
    assert re.search(r"ReadSchema: struct<dt:bigint,temp:double,clouds:int,uv_index:double>", text)
    assert "partial_avg" in text
    assert text.count("Exchange") <= 3  # one exchange, named twice in the listing


def test_wind_does_not_compute_measures_it_does_not_select(spark, stored):
    text = plan(gold.potencial_eolico(silver(spark, stored)))
    assert "_humidity" not in text and "uv_index" not in text


def test_critical_filters_before_the_shuffle(spark, stored):
    text = plan(gold.condiciones_criticas(silver(spark, stored)))
    tree = text.split("(1) ")[0]
    assert tree.index("Exchange") < tree.index("Filter")


def test_site_and_month_filters_reach_the_folders(spark, stored):
    solar = read_gold_normalised(spark, stored + "/gold/potencial_solar")
    text = plan(reports.solar_by_hour(solar, "A", 1))
    assert re.search(r"PartitionFilters: \[.*city#\d+ = A.*month#\d+ = 1", text)


def test_month_refresh_prunes_folders_and_row_groups(spark, stored):
    monthly = read_table(spark, stored + "/monthly")
    months = [row for row in spark.createDataFrame([(2025, 1)], "year int, month int").collect()]
    text = plan(refresh.within_months(monthly, months))
    assert re.search(r"PartitionFilters: \[.*year#\d+ = 2025", text)
    assert "GreaterThanOrEqual(dt,1735689600)" in text and "LessThan(dt,1738368000)" in text


def test_retention_prunes_on_arrival_day(spark, stored, tmp_path):
    import datetime as dt

    rows = silver_rows(spark, {}).withColumns({"topic": F.lit("a"), "year": F.lit(2024), "month": F.lit(1), "day": F.lit(1)})
    write_table(rows, str(tmp_path / "l"), ["topic", "year", "month", "day"])
    text = plan(keep(read_table(spark, str(tmp_path / "l")), dt.date(2024, 1, 1)))
    assert re.search(r"PartitionFilters: \[.*make_date", text)


def test_hot_keys_are_limited_before_the_shuffle(spark, stored):
    rows = silver(spark, stored).withColumn("ingestion_timestamp", F.timestamp_seconds("dt"))
    assert re.search(r"WindowGroupLimit", plan(dedup(rows)))
    assert plan(dedup(rows)).count("Partial") >= 1
    top = top_bottom_n(rows.select("city", "dt", "wind_speed"), ["city"], "wind_speed", "dt", 10)
    tree = plan(top).split("(1) ")[0]
    assert tree.count("WindowGroupLimit") == 4


def test_small_batch_is_broadcast_and_history_is_not_shuffled(spark, stored):
    monthly = read_table(spark, stored + "/monthly")
    batch, _ = stage(monthly.filter("year = 2025 and month = 1"), "batch")
    keys = ["dt", "lat", "lon"]
    counts = pruning.value_counts(batch, ["year", "month"])
    text = plan(append.not_in_target(batch, monthly, keys, ["year", "month"], counts))
    assert "BroadcastHashJoin LeftSemi BuildRight" in text
    assert re.search(r"PartitionFilters: \[isnotnull\(year#\d+\), isnotnull\(month#\d+\), \(year#\d+ = 2025\)", text)


def test_large_batch_is_not_broadcast(spark, stored):
    monthly = read_table(spark, stored + "/monthly")
    counts = pruning.value_counts(monthly, ["year", "month"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(append.not_in_target(monthly, monthly, ["dt", "lat", "lon"], ["year", "month"], counts))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text


def test_writes_rebalance_instead_of_pinning_a_site_to_a_task(spark, stored):
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(gather_partitions(silver(spark, stored), ["city"]))


def test_rebalance_splits_a_hot_site(spark, tmp_path):
    """Nearly all rows belong to one site; the write must not put them into one file."""
    hot = spark.range(400_000).select(
        F.when(F.col("id") % 1_000 == 0, "cold").otherwise("hot").alias("city"), F.col("id"), F.rand(1).alias("v")
    )
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        write_table(hot, str(tmp_path / "hot"), ["city"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
    assert len(list((tmp_path / "hot" / "city=hot").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 400_000


def test_library_collects_only_bounded_facts():
    """Driver-side reads: partition values, and nothing else."""
    found = {
        path.name: path.read_text().count(".collect()")
        for path in LIBRARY
        if ".collect()" in path.read_text()
    }
    assert found == {"pruning.py": 1, "retention.py": 1, "refresh.py": 1}
    for path in LIBRARY:
        text = path.read_text()
        assert "toPandas" not in text and "udf" not in text.lower().replace("no udfs", ""), path
        assert "localCheckpoint" not in text and ".rdd" not in text and "crossJoin" not in text, path


def test_messages_are_parsed_once(spark):
    messages = spark.createDataFrame([(b"{}", "weather_a")], "value binary, topic string")
    for rows in (landing_rows(messages), quarantine_rows(messages)):
        assert plan(rows).split("(1) ")[0].count("Generate") == 1
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_documented_sql_prunes_partitions(spark):
    sf_dir = "/root/testdata/sf0.001"
    if not Path(sf_dir).exists():
        pytest.skip("driver tables are absent")
    for name in ("sql_partition_filter", "sql_partition_limit", "sql_avg_temp_by_city"):
        assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ = 2025", plan(CASES[name].run(spark, sf_dir)))
