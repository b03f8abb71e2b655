import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from solvind.functions.calendar import add_ingestion_partitions, add_time_parts
from solvind.operators import pruning, retention
from solvind.operators.layout import replace_table, write_table
from solvind.plans import gold, jobs, refresh
from solvind.schemas import HISTORY_TABLE, SILVER
from solvind.sources import read_table
from tests.support import epoch, same_rows, silver_rows, values

PARTS = ["city", "year", "month"]


def with_months(df):
    return add_time_parts(df).select(*SILVER.fieldNames(), "year", "month")


def deliveries(spark, *changes, seconds=0):
    rows = with_months(silver_rows(spark, *changes))
    stamped = rows.withColumn("ingestion_timestamp", F.timestamp_seconds(F.lit(1_800_000_000 + seconds)))
    return stamped.select(*HISTORY_TABLE.fieldNames())


def gold_tables(spark, root):
    """Stored Gold, rounded: sums of doubles depend on row order."""
    tables = {}
    for name in gold.GOLD_TABLES:
        stored = read_table(spark, f"{root}/{name}")
        tables[name] = stored.select(*(F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in stored.dtypes))
    return tables


def assert_same_gold(spark, left, right):
    left, right = gold_tables(spark, left), gold_tables(spark, right)
    for name in gold.GOLD_TABLES:
        assert same_rows(left[name], right[name]), name


def test_write_counts_and_reads_back(spark, folder):
    rows = silver_rows(spark, {}, {"city": "Patagonia"}, {"city": "Patagonia", "temp": None})
    assert write_table(rows, folder("t"), ["city"]) == {"rows": 3}
    assert same_rows(read_table(spark, folder("t"), SILVER), rows)
    assert write_table(rows.limit(0), folder("empty"), ["city"]) == {"rows": 0}


def test_dynamic_overwrite_leaves_other_folders(spark, folder):
    write_table(silver_rows(spark, {}, {"city": "Patagonia"}), folder("t"), ["city"])
    write_table(silver_rows(spark, {"temp": 1.0}), folder("t"), ["city"])
    assert sorted(values(read_table(spark, folder("t")), "city", "temp")) == [("Patagonia", 28.0), ("Riohacha", 1.0)]
    write_table(silver_rows(spark, {"temp": 2.0}), folder("t"), ["city"], dynamic=False)
    assert values(read_table(spark, folder("t")), "city", "temp") == [("Riohacha", 2.0)]


def test_replace_table_from_itself(spark, folder):
    write_table(silver_rows(spark, {}, {"city": "Patagonia"}), folder("t"), ["city"])
    stored = read_table(spark, folder("t"))
    assert replace_table(stored.filter("city = 'Patagonia'"), folder("t"), ["city"]) == {"rows": 1}
    assert values(read_table(spark, folder("t")), "city") == [("Patagonia",)]


@pytest.mark.parametrize("path", ["broadcast", "shuffled"])
def test_append_is_idempotent_on_every_join_path(spark, folder, path):
    if path == "shuffled":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _append_repeatedly(spark, folder)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _append_repeatedly(spark, folder):
    changes = [{"dt": epoch(2024, month, 1)} for month in (1, 2, 3)] + [{"lat": None}, {"dt": None}]
    batch = deliveries(spark, *changes)
    first = jobs.consolidate(batch, folder("h"))
    assert first == {"read": 5, "unique": 5, "rows": 5}
    assert jobs.consolidate(batch, folder("h"))["rows"] == 0
    more = deliveries(spark, *changes, {"dt": epoch(2024, 3, 2)}, {"dt": epoch(2024, 3, 2), "temp": 1.0}, seconds=9)
    assert jobs.consolidate(more, folder("h")) == {"read": 7, "unique": 6, "rows": 1}
    assert read_table(spark, folder("h"), HISTORY_TABLE).count() == 6


def first_year(spark):
    return [
        {"city": city, "lat": lat, "dt": epoch(2024, month, day), "wind_speed": float(20 - day)}
        for city, lat in (("Riohacha", 11.5), ("Patagonia", -41.8))
        for month in (1, 2)
        for day in range(1, 16)
    ]


def test_refresh_equals_full_build(spark, folder):
    """The second year pushes every listed day of Patagonia's first year out of both top lists, one row is
    late and one has no time."""
    old = first_year(spark)
    new = [
        {"city": "Patagonia", "dt": epoch(2025, 6, day), "wind_speed": 30.0 + day if day <= 12 else 0.0}
        for day in range(1, 29)
    ]
    new += [{"city": "Patagonia", "dt": epoch(2024, 2, 3, 18), "wind_speed": 9.0}, {"dt": None, "temp": -4.0}]
    before, after = silver_rows(spark, *old), silver_rows(spark, *old, *new)
    touched = refresh.touched_months(silver_rows(spark, *new))
    gold.write_gold(before, folder("listed"))
    gold.write_gold(after, folder("full"))
    refresh.refresh_gold(after, folder("listed"), touched)
    assert_same_gold(spark, folder("listed"), folder("full"))
    ranked_years = values(read_table(spark, folder("listed") + "/ranking_dias").filter("city = 'Patagonia'"), "year")
    assert set(ranked_years) == {(2025,)}


def test_refresh_without_touched_rows_writes_nothing(spark, folder):
    rows = silver_rows(spark, {})
    report = refresh.refresh_gold(rows, folder("gold"), refresh.touched_months(rows.limit(0)))
    assert set(report.values()) == {0}


def test_month_ranges_merge_and_wrap(spark):
    rows = [row for row in spark.createDataFrame([(2024, 12), (2025, 1), (2024, 2)], "year int, month int").collect()]
    first = 2024 * 12
    assert refresh._month_runs(rows) == [(first + 1, first + 2), (first + 11, first + 13)]
    silver = silver_rows(spark, *({"dt": t} for t in (epoch(2024, 11, 30, 23, 59), epoch(2024, 12, 1, 0), epoch(2025, 1, 31, 23, 59), epoch(2025, 2, 1, 0))))
    assert refresh.within_months(silver, rows).count() == 2


def test_update_from_landing_equals_rebuild(spark, folder):
    paths = folder("history"), folder("silver"), folder("gold")
    start = deliveries(spark, *first_year(spark))
    report = jobs.update_from_landing(spark, start, *paths)
    assert (report["rows"], report["silver"]) == (60, 60)
    late = deliveries(spark, {"dt": epoch(2024, 2, 20), "wind_speed": 1.0}, *first_year(spark)[:4], seconds=60)
    report = jobs.update_from_landing(spark, late, *paths)
    assert (report["read"], report["rows"]) == (5, 1)
    silver = read_table(spark, folder("silver"))
    assert silver.count() == 61
    gold.write_gold(silver, folder("full"))
    assert_same_gold(spark, folder("gold"), folder("full"))


def test_silver_job_reads_documents_and_history(spark, folder, tmp_path):
    jobs.consolidate(deliveries(spark, {"dt": epoch(2025, 1, 1)}), folder("history"))
    documents = tmp_path / "documents"
    documents.mkdir()
    text = silver_rows(spark, {}).select(
        F.to_json(F.array(F.struct("dt", "dt_iso", "lat", "lon", F.struct("temp", "humidity").alias("main"))))
    )
    (documents / "a.json").write_text(text.first()[0])
    report = jobs.build_silver(spark, [(str(documents), "Patagonia")], folder("history"), folder("silver"), PARTS)
    assert report == {"rows": 2}
    found = values(read_table(spark, folder("silver")).orderBy("dt"), "city", "year", "temp", "uv_index")
    assert found == [("Patagonia", 2024, 28.0, None), ("Riohacha", 2025, 28.0, 8.0)]
    with pytest.raises(ValueError, match="holds no rows"):
        jobs.build_silver(spark, [], folder("nothing"), folder("silver2"))
    assert jobs.build_gold(spark, folder("silver"), folder("gold"))["potencial_eolico"] == 2


def landing(spark):
    days = [dt.date(2026, 3, 9) - dt.timedelta(days=age) for age in (0, 29, 30, 31, 400)]
    rows = spark.createDataFrame(
        [(topic, dt.datetime(d.year, d.month, d.day, 5, tzinfo=dt.timezone.utc)) for d in days for topic in ("a", "b")],
        "topic string, ingestion_timestamp timestamp",
    )
    return add_ingestion_partitions(rows).withColumn("v", F.lit(1))


def test_retention_boundary(spark):
    cutoff = retention.cutoff_day(dt.date(2026, 3, 9))
    rows = landing(spark)
    assert retention.keep(rows, cutoff).count() == 6
    assert retention.expired(rows, cutoff).count() == 4
    found = values(retention.retention_report(rows, cutoff).orderBy("topic"), "topic", "expired_days", "expired_rows", "kept_rows")
    assert found == [("a", 2, 2, 3), ("b", 2, 2, 3)]


def test_retention_keeps_undated_rows(spark):
    rows = landing(spark).withColumn("year", F.lit(None).cast("int"))
    assert retention.keep(rows, dt.date(2100, 1, 1)).count() == 10


def test_expired_files_by_modification_time(spark, folder):
    write_table(landing(spark), folder("landing"), ["topic", "year", "month", "day"])
    now = dt.datetime.now()
    everything = retention.expired_files(spark, folder("landing"), now + dt.timedelta(days=1))
    assert everything.count() == 10
    assert {"topic", "year", "length", "modificationTime"} <= set(everything.columns)
    (total,) = retention.file_totals(everything).collect()
    assert total["files"] == 10 and total["total_bytes"] > 0
    (none,) = retention.file_totals(retention.expired_files(spark, folder("landing"), now - dt.timedelta(days=1))).collect()
    assert tuple(none) == (0, 0)


def test_drop_expired_partitions(spark, folder):
    spark.sql(f"CREATE DATABASE landing_db LOCATION '{folder('db')}'")
    landing(spark).write.partitionBy("topic", "year", "month", "day").saveAsTable("landing_db.stream")
    assert jobs.expire_landing(spark, "landing_db.stream", dt.date(2026, 3, 9), 30) == 4
    assert spark.table("landing_db.stream").count() == 6
    assert jobs.expire_landing(spark, "landing_db.stream", dt.date(2026, 3, 9), 30) == 0
    spark.sql("DROP DATABASE landing_db CASCADE")


def test_correction_to_normal_removes_the_stale_folder(spark, folder):
    sites = [{"city": city, "clouds": 95, "humidity": 95} for city in ("A", "B")]
    gold.write_gold(silver_rows(spark, *sites), folder("gold"))
    after = silver_rows(spark, {"city": "A", "clouds": 5, "humidity": 50, "temp": 20.0, "wind_speed": 9.0}, sites[1])
    refresh.refresh_gold(after, folder("gold"), refresh.touched_months(after.filter("city = 'A'")))
    assert values(read_table(spark, folder("gold") + "/condiciones_criticas"), "city") == [("B",)]


def test_files_of_untouched_sites_stay(spark, folder):
    paths = folder("history"), folder("silver"), folder("gold")
    jobs.update_from_landing(spark, deliveries(spark, *first_year(spark)), *paths)

    def files(name):
        return {str(file) for file in Path(folder(name)).rglob("part-*")}

    before = files("silver"), files("gold")
    jobs.update_from_landing(spark, deliveries(spark, {"dt": epoch(2024, 2, 20), "city": "Patagonia", "lat": -41.8}, seconds=60), *paths)
    for old, new in zip(before, (files("silver"), files("gold"))):
        touched = {file for file in old if "city=Patagonia/year=2024/month=2" in file}
        untouched = {file for file in old if "city=Riohacha/year=2024/month=" in file or "city=Patagonia/year=2024/month=1/" in file}
        assert touched and untouched and not touched & new and untouched <= new


def test_milliseconds_go_to_quarantine_and_the_job_ends(spark, folder):
    paths = folder("history"), folder("silver"), folder("gold")
    rows = deliveries(spark, {}, {"dt": epoch(2024, 1, 1) * 1000}, {"dt": -(10**11)})
    for _ in range(2):
        report = jobs.update_from_landing(spark, rows, *paths, quarantine=folder("aside"))
    assert (report["read"], report["implausible"], report["rows"]) == (3, 2, 0)
    assert read_table(spark, folder("silver")).count() == 1 and read_table(spark, folder("aside")).count() == 4


@pytest.mark.parametrize("n", [1, 400, 5_000, 20_000])
def test_predicates_of_many_months(spark, n):
    months = [Row(year=1900 + k // 12 + (k % 7 == 0) * 3000, month=k % 12 + 1) for k in range(n)]
    wanted = {(row.year, row.month) for row in months}
    frame = spark.createDataFrame(sorted(wanted)[:50] + [(1, 1), (1899, 12), (99_999, 1)], "year int, month int")
    assert frame.filter(pruning.any_of(months, ["year", "month"])).count() == min(50, len(wanted))
    stamps = silver_rows(spark, {"dt": epoch(1900, 1, 5)}, {"dt": epoch(1899, 12, 31)})
    assert refresh.within_months(stamps, months).count() == (1 if (1900, 1) in wanted else 0)


def test_nothing_staged_is_left(spark, folder, monkeypatch):
    from solvind import workspace

    root = Path(folder("shared"))
    root.mkdir()
    monkeypatch.setattr(workspace, "shared_root", lambda spark: str(root))
    paths = folder("history"), folder("silver"), folder("gold")
    jobs.update_from_landing(spark, deliveries(spark, *first_year(spark)), *paths)
    assert not list(root.iterdir())


def test_overlapping_documents_and_history_give_one_row(spark, folder, tmp_path):
    jobs.consolidate(deliveries(spark, {"temp": 1.0}), folder("history"))
    documents = tmp_path / "documents"
    documents.mkdir()
    (documents / "a.json").write_text('[{"dt": 1704110400, "lat": 11.5, "lon": -72.9, "main": {"temp": 2.0, "pressure": 1012.6}}, {"dt": 1704114000, "lat": 11.5, "lon": -72.9, "main": {"pressure": 1013.25}}]')
    (documents / "b.json").write_text("[{broken")
    sources = [(str(documents), "Riohacha")]
    report = jobs.build_silver(spark, sources, folder("history"), folder("silver"), quarantine=folder("aside"))
    assert report == {"rows": 2, "unreadable": 1}
    assert sorted(values(read_table(spark, folder("silver")), "dt", "temp", "pressure")) == [(1704110400, 1.0, 1012), (1704114000, None, 1013)]
    assert values(read_table(spark, folder("aside")), "city", "text") == [("Riohacha", "[{broken")]
