import pytest
from pyspark.sql import functions as F

from solvind.operators import messages as topics
from solvind.operators.dedup import dedup
from solvind.operators.normalise import normalise, safe_cast, tag_city, union_sources, unwrap_envelope
from solvind.operators.quality import dq_report, require_fields, require_rows
from solvind.plans import catalog
from solvind.schemas import ENVELOPE, HISTORY_DOCUMENT, SILVER, TOPIC_ROWS
from solvind.sources import message_source, read_gold_normalised, read_json_history, read_landing, read_table
from tests.support import DEFAULTS, same_rows, silver_rows, values

DOCUMENT = (
    '{"dt": 1704110400, "dt_iso": "2024-01-01 12:00:00", "lat": 11.5, "lon": -72.9, "main": {"temp": 28.0, '
    '"temp_min": 26.0, "temp_max": 31.0, "feels_like": 29.0, "pressure": 1012, "humidity": 70}, '
    '"clouds": {"all": 20}, "wind": {"speed": 6.0, "deg": 90}, "uv_index": 8.0}'
)
MESSAGE = (
    '{"coord": {"lon": -72.9, "lat": 11.5}, "main": {"temp": 28.0, "humidity": 70, "pressure": 1012}, '
    '"wind": {"speed": 6.0, "deg": 90}, "clouds": {"all": 20}, "dt": 1704110400, "name": "Riohacha"}'
)


def topic_rows(spark, *texts):
    return spark.createDataFrame(
        [(None if text is None else bytearray(text, "utf8"), "weather_riohacha") for text in texts], TOPIC_ROWS
    )


def test_history_arrays_and_lines_agree(spark, tmp_path):
    (tmp_path / "array.json").write_text(f"[\n{DOCUMENT},\n{DOCUMENT}\n]")
    (tmp_path / "lines.json").write_text(f"{DOCUMENT}\n{DOCUMENT}\n")
    arrays = read_json_history(spark, str(tmp_path / "array.json"))
    lines = read_json_history(spark, str(tmp_path / "lines.json"), multiline=False)
    assert arrays.schema == HISTORY_DOCUMENT
    assert same_rows(normalise(arrays, "Riohacha"), normalise(lines, "Riohacha"))
    assert same_rows(normalise(arrays, "Riohacha"), silver_rows(spark, {}, {}))


def test_document_without_uv_reads_as_null(spark, tmp_path):
    (tmp_path / "a.json").write_text("[" + DOCUMENT.replace(', "uv_index": 8.0', "") + "]")
    assert values(normalise(read_json_history(spark, str(tmp_path)), "Riohacha"), "uv_index", "temp") == [(None, 28.0)]


def test_missing_landing_is_empty_but_other_errors_are_raised(spark, tmp_path):
    assert read_landing(spark, str(tmp_path / "none")).isEmpty()
    with pytest.raises(Exception, match="(?i)avro|DATA_SOURCE"):
        read_landing(spark, str(tmp_path), "avro").count()
    with pytest.raises(ValueError, match="unknown message source"):
        message_source(spark, "carrier-pigeon")


def test_normalise_accepts_flat_rows(spark):
    rows = silver_rows(spark, {"uv_index": None})
    assert same_rows(normalise(rows), rows)


def test_normalise_bad_text_becomes_null(spark):
    rows = silver_rows(spark, {}).withColumns({"temp": F.lit("n/a"), "humidity": F.lit("81")})
    assert values(require_fields(normalise(rows), SILVER), "temp", "humidity") == [(None, 81)]


def test_normalise_kelvin(spark):
    rows = silver_rows(spark, {"temp": 300.15, "temp_min": None})
    (row,) = normalise(rows, temp_unit="K").collect()
    assert (row["temp"], row["temp_min"]) == (pytest.approx(27.0), None)
    with pytest.raises(ValueError, match="unknown temperature unit"):
        normalise(rows, temp_unit="F")


def test_envelope_to_silver(spark, tmp_path):
    payload = MESSAGE.replace('"pressure": 1012', '"pressure": 1012, "temp_min": 26.0')
    record = f'{{"_airbyte_ab_id": "a", "_airbyte_emitted_at": 1704110401500, "_airbyte_data": {payload}}}'
    (tmp_path / "part.json").write_text(record + "\n")
    landed = read_landing(spark, str(tmp_path))
    assert landed.schema == ENVELOPE
    opened = unwrap_envelope(landed)
    assert values(opened, F.unix_millis("ingestion_timestamp"), "coord.lat") == [(1704110401500, 11.5)]
    found = normalise(opened)
    assert values(found, "city", "lat", "temp_min", "clouds", "uv_index") == [("Riohacha", 11.5, 26.0, 20, None)]
    assert "ingestion_timestamp" in found.columns


def test_tag_city(spark):
    rows = spark.createDataFrame([("weather_patagonia",), ("weather_puerto lopez",)], "topic string")
    assert values(tag_city(rows), "city") == [("Patagonia",), ("Puerto Lopez",)]
    assert values(tag_city(rows, "X"), "city") == [("X",), ("X",)]


def test_safe_cast(spark):
    rows = spark.createDataFrame([("7",), ("x",), (None,)], "v string")
    assert values(safe_cast(rows, {"v": "int"}), "v") == [(7,), (None,), (None,)]


def test_union_by_name(spark):
    left = spark.createDataFrame([(1, "a")], "x int, y string")
    right = spark.createDataFrame([("b", 2.5)], "y string, z double")
    assert sorted(values(union_sources(left, right), "x", "y", "z"), key=repr) == [(1, "a", None), (None, "b", 2.5)]


MILLISECONDS = MESSAGE.replace("1704110400", "1704110400000")


def test_good_and_malformed_messages(spark):
    texts = [MESSAGE, "{bad", "", None, '{"name": "no time"}', MESSAGE.replace("28.0", '"hot"'), MILLISECONDS]
    parsed = topics.parse_messages(topic_rows(spark, *texts))
    good, bad = topics.split_malformed(parsed)
    assert good.count() + bad.count() == len(texts)
    assert values(topics.flatten_messages(good), "dt", "temp", "wind_deg", "city_name") == [
        (1704110400, 28.0, 90, "Riohacha"),
        (1704110400, None, 90, "Riohacha"),
    ]
    assert {text for (text,) in values(bad, "json_string")} == {"{bad", "", None, '{"name": "no time"}', MILLISECONDS}


def test_flatten_stamps_ingestion(spark):
    parsed = topics.parse_messages(topic_rows(spark, MESSAGE))
    assert values(topics.flatten_messages(parsed), F.col("ingestion_timestamp").isNotNull()) == [(True,)]
    fixed = topics.flatten_messages(parsed, F.timestamp_seconds(F.lit(7)))
    assert values(fixed, F.unix_seconds("ingestion_timestamp")) == [(7,)]


def test_dedup_keeps_latest_of_a_hot_key(spark):
    many = spark.range(30_000).select(
        F.lit(1).cast("bigint").alias("dt"),
        F.lit(1.0).alias("lat"),
        F.lit(2.0).alias("lon"),
        F.timestamp_seconds(F.col("id")).alias("ingestion_timestamp"),
        F.col("id").alias("payload"),
    )
    few = spark.range(100).select(
        (F.col("id") + 10).alias("dt"),
        F.lit(1.0).alias("lat"),
        F.lit(2.0).alias("lon"),
        F.timestamp_seconds(F.lit(0)).alias("ingestion_timestamp"),
        F.col("id").alias("payload"),
    )
    unique = dedup(many.unionByName(few).repartition(5))
    assert unique.count() == 101
    assert values(unique.filter("dt = 1"), "payload") == [(29_999,)]


def test_dedup_ties_do_not_depend_on_partitioning(spark):
    rows = silver_rows(spark, {"temp": 3.0}, {"temp": 1.0}, {"temp": 2.0}, {"lat": None}, {"lat": None})
    stamped = rows.withColumn("ingestion_timestamp", F.timestamp_seconds(F.lit(1)))
    for parts in (1, 3, 5):
        found = dedup(stamped.repartition(parts, "temp"))
        assert sorted(values(found, "lat", "temp"), key=repr) == [(11.5, 1.0), (None, 28.0)]


def test_quality_report_counts_each_rule(spark):
    rows = silver_rows(
        spark,
        {},
        {"temp": None, "humidity": None},
        {"lat": 91.0, "uv_index": None},
        {"dt": 0},
        {"dt": None, "lon": None},
        {"dt_iso": None},
        {"dt_iso": "not a time"},
    )
    found = {row["rule"]: row["violations"] for row in dq_report(rows).collect()}
    assert found == {
        "temp_missing": 1,
        "humidity_missing": 1,
        "wind_speed_missing": 0,
        "uv_index_missing": 1,
        "dt_not_epoch": 2,
        "dt_iso_differs": 1,
        "latitude_out_of_range": 1,
        "longitude_out_of_range": 1,
    }
    assert {row["checked"] for row in dq_report(rows).collect()} == {7}


def test_gates(spark):
    rows = silver_rows(spark, {})
    assert require_rows(rows) is rows
    with pytest.raises(ValueError, match="Silver holds no rows"):
        require_rows(rows.limit(0), "Silver")
    with pytest.raises(ValueError, match="temp: expected double, found string; uv_index: expected double, found nothing"):
        require_fields(rows.withColumn("temp", F.lit("x")).drop("uv_index"), SILVER)


def test_gold_loader_trims_and_coerces(spark, folder):
    path = folder("gold")
    rows = spark.createDataFrame([("a", "2024", "x", 1.0), ("b", "2025", "3", 2.0)], "city string, year string, hour string, ` v ` double")
    rows.write.partitionBy("city", "year").parquet(path)
    (spark.createDataFrame([("noise",)], "t string").coalesce(1).write.mode("append").text(path + "/city=a/year=2024"))
    found = read_gold_normalised(spark, path)
    assert dict(found.dtypes) == {"hour": "int", "v": "double", "city": "string", "year": "int"}
    assert sorted(values(found, "city", "year", "hour", "v")) == [("a", 2024, None, 1.0), ("b", 2025, 3, 2.0)]


def test_catalog_and_documented_sql(spark, folder):
    rows = silver_rows(spark, {}, {"temp": 30.0}, {"city": "Patagonia"}).withColumns({"year": F.lit(2026), "month": F.lit(3)})
    parts = ["city", "year", "month"]
    rows.write.partitionBy(*parts).parquet(folder("silver"))
    catalog.create_database(spark, "silver_db", folder("db"))
    table = catalog.register_table(spark, "silver_db.weather_unified", folder("silver"), rows.schema, parts)
    assert same_rows(table, read_table(spark, "silver_db.weather_unified"))
    assert table.count() == 3
    name = "silver_db.weather_unified"
    assert sorted(values(catalog.avg_temp_by_city(spark, name, 2026, 3), "city", "temp_promedio")) == [
        ("Patagonia", 28.0),
        ("Riohacha", 29.0),
    ]
    assert sorted(values(catalog.count_by_city(spark, name), "city", "total")) == [("Patagonia", 1), ("Riohacha", 2)]
    assert catalog.partition_rows(spark, name, "Riohacha", 2026, 3).count() == 2
    assert values(catalog.partition_head(spark, name, "Riohacha", 2026, 3, 1), "temp") == [(28.0,)]
    from solvind.sources import describe_table

    described = dict(values(describe_table(spark, name), "col_name", "data_type"))
    assert described["temp"] == "double"
    assert described["city"] == "string"
    view = catalog.governed_view(table, "only_riohacha", ["city", "temp"], F.col("city") == "Riohacha")
    assert view.columns == ["city", "temp"]
    assert spark.table("only_riohacha").count() == 2
    spark.sql("DROP DATABASE silver_db CASCADE")


def test_defaults_match_the_contract():
    assert set(DEFAULTS) == set(SILVER.fieldNames())
