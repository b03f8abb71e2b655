"""Headline timings as one JSON line.

`BENCH_SF_DIR` (default sf0.1) and `BENCH_CPUS` (default 4) choose input and cores. Each query is run
three times and the best wall time counts; results are fully computed, through the `noop` sink or a
real Parquet write.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from acceptance import CASES  # noqa: E402
from acceptance.base import CITIES, documents, envelopes, messages, silver, weather  # noqa: E402
from solvind.plans import jobs, reports  # noqa: E402
from solvind.session import build_session  # noqa: E402
from solvind.sources import message_source, read_table  # noqa: E402
from solvind.workspace import fresh_path  # noqa: E402

RUNS = 3
HEADLINE = (
    "gold_potencial_solar",
    "gold_potencial_eolico",
    "gold_condiciones_criticas",
    "gold_analisis_comparativo",
    "gold_ranking_dias",
    "daily_scores",
    "top_bottom_n",
    "dedup_observations",
    "parse_messages",
    "dq_report",
    "bi_kpis",
    "bi_wind_box",
    "bi_scatter_sample",
)


def best(run) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def once(run) -> float:
    """For jobs that change what they read."""
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def folder_bytes(path: str) -> int:
    return sum(file.stat().st_size for file in Path(path.removeprefix("file:")).rglob("part-*"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__sql__shuffle__partitions=cpus
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = silver(spark, sf_dir).count()

    for _ in range(RUNS):  # start the JVM's compilers before anything is timed
        CASES[HEADLINE[0]].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    queries = {}
    for name in HEADLINE:
        queries[name] = best(lambda: CASES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save())

    # The batch pipeline as the jobs run it: documents -> Silver -> five Gold tables, all written.
    lines, stored, root = (fresh_path(spark, name) for name in ("documents", "silver", "gold"))
    nested = documents(weather(spark, sf_dir)).drop("event_id")
    nested.write.partitionBy("city").json(lines)
    sources = [(f"{lines}/city={city}", city) for city in CITIES]
    queries["job_silver"] = best(lambda: jobs.build_silver(spark, sources, None, stored, multiline=False))
    queries["job_gold_all"] = best(lambda: jobs.build_gold(spark, stored, root))

    # The jobs with joins: two overlapping deliveries into history, Silver and Gold, and a drained stream.
    landing = fresh_path(spark, "landing")
    envelopes(weather(spark, sf_dir)).write.json(landed := f"{landing}/all")
    late = jobs.landing_as_history(spark, landed, "json")
    queries["job_consolidate"] = once(lambda: jobs.consolidate(late, f"{landing}/history"))
    queries["job_consolidate_again"] = once(lambda: jobs.consolidate(late, f"{landing}/history"))
    lake = [f"{landing}/{name}" for name in ("history2", "silver", "gold")]
    queries["job_update"] = once(lambda: jobs.update_from_landing(spark, late, *lake))
    month = late.filter("year = 2024 and month = 1")
    queries["job_update_month"] = once(lambda: jobs.update_from_landing(spark, month, *lake))
    messages(weather(spark, sf_dir)).write.parquet(f"{landing}/topic")
    source = message_source(spark, "files", path=f"{landing}/topic")
    queries["job_stream_drain"] = once(
        lambda: jobs.ingest_messages(source, f"{landing}/stream", f"{landing}/checkpoint", every=None).awaitTermination()
    )
    queries["bi_solar_by_hour_stored"] = best(
        lambda: reports.solar_by_hour(read_table(spark, f"{root}/potencial_solar"), CITIES[0], 1).collect()
    )

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "rows": rows,
                "parquet_to_json_bytes": round(folder_bytes(stored) / folder_bytes(lines), 4),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
