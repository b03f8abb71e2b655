import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from solvind.plans import jobs
from solvind.schemas import TOPIC_ROWS
from solvind.sources import message_source, read_table
from solvind.streaming import ingest, ledger
from tests.support import epoch, values


def message(observed, city="Riohacha", temp=28.0):
    return json.dumps(
        {
            "coord": {"lon": -72.9, "lat": 11.5},
            "main": {"temp": temp, "humidity": 70, "pressure": 1012},
            "wind": {"speed": 6.0, "deg": 90},
            "clouds": {"all": 20},
            "dt": observed,
            "name": city,
        }
    )


@pytest.fixture
def lake(spark, folder):
    class Lake:
        topic, landing, checkpoint = folder("topic"), folder("landing"), folder("checkpoint")

        def publish(self, *texts, topic="weather_riohacha"):
            rows = [(bytearray(text, "utf8"), topic) for text in texts]
            spark.createDataFrame(rows, TOPIC_ROWS).coalesce(1).write.mode("append").parquet(self.topic)

        def messages(self):
            return message_source(spark, "files", path=self.topic)

        def drain(self, rows, **options):
            ingest.start_ingest(rows, self.landing, self.checkpoint, every=None, **options).awaitTermination()

        def landed(self):
            return read_table(spark, self.landing)

    return Lake()


def test_restart_adds_only_what_is_new(lake):
    arrival = F.timestamp_seconds(F.col("data.dt") + 60)
    lake.publish(message(epoch(2024, 1, 1)), "{bad")
    lake.drain(ingest.landing_rows(lake.messages(), arrival))
    assert values(lake.landed(), "topic", "year", "month", "day", "temp", "pressure", "wind_deg") == [
        ("weather_riohacha", 2024, 1, 1, 28.0, 1012, 90)
    ]
    lake.publish(message(epoch(2024, 1, 2)))
    lake.drain(ingest.landing_rows(lake.messages(), arrival))
    lake.drain(ingest.landing_rows(lake.messages(), arrival), retention="30d")
    assert sorted(values(lake.landed(), "day")) == [(1,), (2,)]


def test_malformed_messages_are_kept_aside(lake):
    lake.publish(message(epoch(2024, 1, 1)), "{bad", "")
    lake.drain(ingest.quarantine_rows(lake.messages()), partition_by=["topic"])
    assert {text for (text,) in values(lake.landed(), "json_string")} == {"{bad", ""}


def test_repeats_within_the_watermark_are_dropped(lake):
    texts = [message(epoch(2024, 1, 1, hour)) for hour in (1, 2, 3)]
    lake.publish(*texts, *texts)
    rows = ingest.dedup_within_watermark(ingest.landing_rows(lake.messages()))
    lake.drain(rows, partition_by=["topic"])
    lake.publish(texts[-1], message(epoch(2024, 1, 1, 4)))
    rows = ingest.dedup_within_watermark(ingest.landing_rows(lake.messages()))
    lake.drain(rows, partition_by=["topic"])
    assert sorted(values(lake.landed(), "dt")) == [(epoch(2024, 1, 1, hour),) for hour in (1, 2, 3, 4)]


def test_landing_table_feeds_history(spark, lake, folder):
    lake.publish(message(epoch(2024, 1, 1)), message(epoch(2024, 1, 1), temp=30.0))
    lake.publish(message(epoch(2024, 1, 2), city="x"), topic="weather_patagonia")
    lake.drain(ingest.landing_rows(lake.messages(), F.timestamp_seconds(F.col("data.dt") + 60)))
    rows = jobs.landing_as_history(spark, lake.landing, "stream")
    report = jobs.consolidate(rows, folder("history"))
    assert report == {"read": 3, "unique": 2, "rows": 2}
    found = values(read_table(spark, folder("history")).orderBy("dt"), "city", "pressure", "uv_index", "month")
    assert found == [("Riohacha", 1012, None, 1), ("Patagonia", 1012, None, 1)]
    recent = jobs.landing_as_history(spark, lake.landing, "stream", since=dt.date(2024, 1, 2))
    assert values(recent, "city") == [("Patagonia",)]
    with pytest.raises(ValueError, match="unknown landing kind"):
        jobs.landing_as_history(spark, lake.landing, "csv")


def test_stream_consolidation_survives_a_kill_and_a_replay(spark, lake, folder):
    arrival = F.timestamp_seconds(F.col("data.dt") + 60)
    for day in (1, 2, 3):
        lake.publish(message(epoch(2024, 1, day)), message(epoch(2024, 1, day, 13), temp=99.0), message(epoch(2024, 1, 1)))
    lake.drain(ingest.landing_rows(lake.messages(), arrival))
    landing, history, checkpoint, aside = (folder(name) for name in ("mistaken", "history", "follow", "aside"))
    mistaken = F.when(F.col("temp") == 99, F.col("dt") * 1000).otherwise(F.col("dt"))  # milliseconds
    lake.landed().withColumn("dt", mistaken).coalesce(1).write.partitionBy(*ingest.LANDING_PARTITIONS).parquet(landing)

    def run(on_written=None):
        options = {"quarantine": aside, "max_files": 1, "on_written": on_written}
        jobs.consolidate_stream(spark, landing, history, checkpoint, **options).awaitTermination()

    def die(batch_id, report):
        if batch_id == 1:
            raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        run(die)
    before = values(ledger.read_ledger(spark, history), "batch")
    assert before == [(0,)]
    run()
    run()
    assert sorted(values(read_table(spark, history), "dt")) == [(epoch(2024, 1, day),) for day in (1, 2, 3)]
    found = ledger.read_ledger(spark, history)
    assert sorted(values(found, "batch")) == [(batch,) for batch in range(found.count())]
    assert sum(json.loads(text)["read"] for (text,) in values(found, "report")) == lake.landed().count()
    bad = [epoch(2024, 1, day, 13) * 1000 for day in (1, 2, 3)]
    assert sorted(values(read_table(spark, aside), "dt")) == [(at,) for at in bad]


def test_a_batch_in_the_ledger_is_not_done_again(spark, folder):
    table, checkpoint, calls = folder("table"), folder("checkpoint"), []
    for name in ("one", "two"):
        spark.createDataFrame([(name,)], "id string").coalesce(1).write.json(f"{checkpoint}-{name}/metadata")
        run = ledger.once_per_batch(spark, table, f"{checkpoint}-{name}", lambda batch, at: calls.append(at) or {"rows": at})
        assert ledger.read_ledger(spark, table).count() == len(calls)
        for batch_id in (0, 1, 1, 0, 2):
            run(spark.range(1), batch_id)
    assert calls == [0, 1, 2, 0, 1, 2]  # a new checkpoint counts its batches anew
    assert sorted(values(ledger.read_ledger(spark, table), "stream", "batch", "report"))[:2] == [("one", 0, '{"rows": 0}'), ("one", 1, '{"rows": 1}')]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        message_source(spark, "kafka", servers="host:9092", topics="a,b")
