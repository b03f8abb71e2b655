import pytest
from pyspark.sql import functions as F

from solvind.operators.ranking import top_bottom_n
from solvind.operators.sampling import hash_sample
from solvind.plans import gold, reports
from tests.support import epoch, same_rows, silver_rows, values


@pytest.fixture(scope="module")
def year_of_days(spark):
    """Two sites, 40 days, three readings a day; equal wind on many days so that scores tie."""
    changes = [
        {"city": city, "dt": epoch(2024, 1 + day // 31, 1 + day % 31, hour), "wind_speed": float(day % 7), "uv_index": 5.0}
        for city in ("Riohacha", "Patagonia")
        for day in range(40)
        for hour in (6, 12, 20)
    ]
    return silver_rows(spark, *changes).persist()


def test_solar_averages_rounded_values(spark):
    rows = silver_rows(
        spark,
        {"dt": epoch(2024, 1, 1, 12, 5), "uv_index": 0.25, "clouds": 50},
        {"dt": epoch(2024, 1, 1, 12, 55), "uv_index": 0.25, "clouds": 50},
        {"dt": epoch(2024, 1, 1, 13), "uv_index": None},
    )
    found = {row["hour"]: row for row in gold.potencial_solar(rows).collect()}
    assert found[12]["potencial_solar_promedio"] == 0.13
    assert found[13]["potencial_solar_promedio"] is None
    assert found[13]["nubosidad_promedio"] == 20.0


def test_wind_counts_every_row(spark, year_of_days):
    wind = gold.potencial_eolico(year_of_days)
    assert wind.agg(F.sum("mediciones")).first()[0] == year_of_days.count()
    assert wind.count() == 80


def test_wind_with_missing_values(spark):
    rows = silver_rows(spark, {"wind_speed": None, "wind_deg": None}, {"wind_speed": 4.0, "wind_deg": None})
    (row,) = gold.potencial_eolico(rows).collect()
    assert (row["velocidad_viento_promedio"], row["direccion_viento_promedio"], row["mediciones"]) == (4.0, None, 2)


def test_direction_arithmetic_and_circular(spark):
    rows = silver_rows(spark, {"wind_deg": 359}, {"wind_deg": 1})
    (row,) = gold.wind_direction(rows).collect()
    assert row["direccion_viento_promedio"] == 180.0
    assert min(row["direccion_viento_circular"], 360 - row["direccion_viento_circular"]) == pytest.approx(0, abs=1e-9)


def test_critical_leaves_out_all_normal(spark):
    rows = silver_rows(spark, {}, {"clouds": 90}, {"clouds": 90, "dt": epoch(2024, 1, 2)}, {"temp": -3.0})
    found = sorted(values(gold.condiciones_criticas(rows), "reduccion_solar", "condicion_adversa", "ocurrencias"))
    assert found == [("Alta nubosidad", "Normal", 2), ("Normal", "Congelamiento", 1)]


def test_comparison_from_days_equals_direct(spark, year_of_days):
    direct = gold.analisis_comparativo(year_of_days)
    merged = gold.gold_frames(year_of_days, gold.by_day(year_of_days))["analisis_comparativo"]
    rounded = [[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in f.dtypes] for f in (direct, merged)]
    assert same_rows(direct.select(*rounded[0]), merged.select(*rounded[1]))


def test_ranks_are_reverse_of_each_other(spark, year_of_days):
    ranking = gold.ranking_dias(year_of_days)
    assert ranking.filter(F.col("rank_mejor") + F.col("rank_peor") != 41).isEmpty()
    assert values(ranking.groupBy("city").count().orderBy("city"), "count") == [(20,), (20,)]
    assert ranking.filter((F.col("tipo_dia") == "Top 10 Mejores") & (F.col("rank_mejor") > 10)).isEmpty()


def test_few_days_carry_the_best_label(spark):
    rows = silver_rows(spark, *({"dt": epoch(2024, 1, day), "wind_speed": float(day)} for day in range(1, 6)))
    ranking = gold.ranking_dias(rows)
    assert ranking.count() == 5
    assert {label for (label,) in values(ranking, "tipo_dia")} == {"Top 10 Mejores"}


def test_equal_scores_rank_by_date(spark):
    rows = silver_rows(spark, *({"dt": epoch(2024, 1, day)} for day in (3, 1, 2)))
    found = sorted(values(gold.ranking_dias(rows), "rank_mejor", "date", "rank_peor"))
    assert found == [(1, "2024-01-01", 3), (2, "2024-01-02", 2), (3, "2024-01-03", 1)]


def test_day_without_score_is_worst_unless_dropped(spark):
    rows = silver_rows(spark, {"dt": epoch(2024, 1, 1), "uv_index": None}, {"dt": epoch(2024, 1, 2)})
    assert values(gold.ranking_dias(rows).filter("rank_peor = 1"), "date", "score_total") == [("2024-01-01", None)]
    assert values(gold.ranking_dias(rows, drop_null_scores=True), "date") == [("2024-01-02",)]


def test_site_time_moves_the_day(spark):
    rows = silver_rows(spark, {"dt": epoch(2024, 1, 1, 2)})
    assert values(gold.potencial_solar(rows, tz="America/Bogota"), "year", "day", "hour") == [(2023, 31, 21)]
    assert values(gold.daily_scores(rows, tz="America/Bogota"), "date") == [("2023-12-31",)]


@pytest.mark.parametrize("n", [1, 3, 30, 100])
def test_top_bottom_n_against_sorting(spark, n):
    """One group holds most rows; scores repeat; some are missing."""
    data = [("hot" if i % 10 else f"g{i % 30}", i, None if i % 13 == 0 else float(i * 7 % 11)) for i in range(400)]
    frame = spark.createDataFrame(data, "g string, id int, score double").repartition(4)
    expected = set()
    for group in {row[0] for row in data}:
        members = [row for row in data if row[0] == group]
        members.sort(key=lambda row: (row[2] is None, -(row[2] or 0.0), row[1]))
        size = len(members)
        for rank, row in enumerate(members, 1):
            if rank <= n or size + 1 - rank <= n:
                expected.add((group, row[1], rank, size + 1 - rank))
    found = values(top_bottom_n(frame, ["g"], "score", "id", n), "g", "id", "rank_mejor", "rank_peor")
    assert len(found) == len(set(found))
    assert set(found) == expected


def test_hash_sample_is_exact_and_repeatable(spark):
    frame = spark.range(5_000).select(F.col("id"), (F.col("id") % 7).alias("v"))
    first = values(hash_sample(frame, 321, ["id"]), "id")
    again = values(hash_sample(frame.repartition(7), 321, ["id"]), "id")
    assert len(set(first)) == 321
    assert set(first) == set(again)
    assert set(first) != set(values(hash_sample(frame, 321, ["id"], seed=2), "id"))
    digests = frame.withColumn("d", F.md5(F.concat_ws("|", F.lit("1"), F.col("id").cast("string"))))
    assert set(first) == set(values(digests.orderBy("d").limit(321), "id"))


@pytest.mark.parametrize("n", [0, 1, 49, 50, 51])
def test_hash_sample_around_the_table_size(spark, n):
    assert hash_sample(spark.range(50), n, ["id"]).count() == min(n, 50)


def test_hash_sample_of_copies(spark):
    copies = spark.range(1_000).select(F.lit(1).alias("id"))
    assert hash_sample(copies, 10, ["id"]).count() == 10


def test_reports_over_two_years(spark):
    rows = silver_rows(
        spark,
        *({"dt": epoch(year, month, day, 12), "wind_speed": float(year - 2020 + day)} for year in (2024, 2025) for month in (1, 2) for day in (1, 2)),
    )
    solar, wind, ranking = gold.potencial_solar(rows), gold.potencial_eolico(rows), gold.ranking_dias(rows)
    (kpi,) = reports.kpis(solar, wind, ranking).collect()
    assert (kpi["dias_en_ranking"], kpi["ubicaciones"]) == (8, 1)
    assert kpi["viento_promedio"] == pytest.approx(6.0)
    assert values(reports.selectors(solar, "month"), "month") == [(1,), (2,)]
    assert reports.wind_by_month(wind).count() == 2
    assert reports.city_comparison(gold.analisis_comparativo(rows)).count() == 4
    (box,) = reports.wind_box(wind).collect()
    assert (box["minimo"], box["mediana"], box["maximo"], box["dias"]) == (5.0, 6.0, 7.0, 8)
    (rough,) = reports.wind_box(wind, approximate=True).collect()
    assert rough["minimo"] <= rough["q1"] <= rough["q3"] <= rough["maximo"]
    detail = values(reports.ranking_detail(ranking, "Riohacha"), "score_total")
    assert detail == sorted(detail, reverse=True)
    assert reports.preview(rows, 3).count() == 3


def test_kpis_of_empty_tables(spark):
    rows = silver_rows(spark, {}).limit(0)
    found = reports.kpis(gold.potencial_solar(rows), gold.potencial_eolico(rows), gold.ranking_dias(rows))
    assert values(found, "dias_en_ranking", "solar_promedio", "viento_promedio", "ubicaciones") == [(0, None, None, 0)]
