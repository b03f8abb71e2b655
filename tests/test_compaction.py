"""Compaction of the landing table: the same rows from fewer files, whatever dies in between."""

import glob

import pytest
from pyspark.sql import functions as F

from solvind.operators import compaction
from solvind.operators.compaction import compact, compacted_path, plan, read_landed, table_files
from solvind.plans import jobs
from solvind.schemas import TOPIC_ROWS
from solvind.sources import message_source
from solvind.streaming import ingest
from tests.support import epoch, values
from tests.test_streaming import message


@pytest.fixture
def lake(spark, folder):
    class Lake:
        topic, path, checkpoint = folder("topic"), folder("landing"), folder("checkpoint")

        def land(self, *observed, city="riohacha"):
            """One micro-batch for each observation time."""
            for at in observed:
                rows = [(bytearray(message(at), "utf8"), f"weather_{city}")]
                spark.createDataFrame(rows, TOPIC_ROWS).coalesce(1).write.mode("append").parquet(self.topic)
            source = message_source(spark, "files", path=self.topic, maxFilesPerTrigger="1")
            ingest.start_ingest(ingest.landing_rows(source, F.timestamp_seconds(F.col("data.dt") + 60)), self.path, self.checkpoint, every=None).awaitTermination()

        def rows(self):
            return sorted(values(read_landed(spark, self.path), "dt", "topic", "day"))

        def files(self):
            return table_files(spark, self.path).count()

    return Lake()


HOURS = [epoch(2024, 1, day, hour) for day in (1, 2) for hour in range(4)]


def test_rows_stay_and_files_go(spark, lake):
    lake.land(*HOURS)
    before = lake.rows()
    assert len(before) == 8 and lake.files() == 8
    planned = read_landed(spark, lake.path)  # a reader that has listed its files
    assert compact(spark, lake.path, now=1000.0) == {"before": 8, "after": 2, "removed": 0}
    assert lake.rows() == before and lake.files() == 2
    assert sorted(values(planned, "dt")) == [(at,) for at in sorted(HOURS)]
    assert compact(spark, lake.path, now=2000.0) == {"before": 0, "after": 0, "removed": 0}
    assert compact(spark, lake.path, grace=500, now=2000.0)["removed"] == 8
    assert lake.rows() == before and not glob.glob(f"{lake.path}/**/*.parquet", recursive=True)
    recent = jobs.landing_as_history(spark, lake.path, "stream", since=None)
    assert recent.count() == 8


def test_the_stream_goes_on(spark, lake):
    lake.land(*HOURS)
    compact(spark, lake.path, grace=0)
    late = [epoch(2024, 1, 1, 20), epoch(2024, 1, 3)]
    lake.land(*late)
    assert [at for at, _, _ in lake.rows()] == sorted(HOURS + late)
    assert lake.files() == 4
    # The next run puts the new file to the old one; the third day's only file stays as it is.
    assert compact(spark, lake.path, grace=0, now=4e9)["before"] == 2
    assert [at for at, _, _ in lake.rows()] == sorted(HOURS + late) and lake.files() == 3
    lake.land(epoch(2024, 1, 3, 1), city="patagonia")
    assert len(lake.rows()) == 11


def test_death_before_the_commit(spark, lake, monkeypatch):
    lake.land(*HOURS)
    before = lake.rows()

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "_commit", die)
        with pytest.raises(KeyboardInterrupt):
            compact(spark, lake.path, grace=0)
    assert lake.rows() == before and lake.files() == 8
    open(f"{compacted_path(lake.path)}/keep", "w").close()
    assert compact(spark, lake.path, grace=0, now=4e9)["before"] == 8
    assert lake.rows() == before and lake.files() == 2
    assert len(glob.glob(f"{compacted_path(lake.path)}/gen=*")) == 1  # what the dead run wrote is gone


def test_death_within_and_after_the_commit(spark, lake, monkeypatch):
    lake.land(*HOURS)
    before = lake.rows()
    create = compaction._Files.create
    with monkeypatch.context() as patch:
        patch.setattr(compaction._Files, "create", lambda self, path, text: create(self, path, ""))  # died before it wrote the id
        compact(spark, lake.path, grace=1e9)
    assert lake.rows() == before and lake.files() == 8
    with pytest.raises(RuntimeError, match="is committing"):
        compact(spark, lake.path, grace=1e9)
    assert lake.rows() == before
    monkeypatch.setattr(compaction, "COMMIT_SECONDS", -1e9)  # as if that was long ago
    assert compact(spark, lake.path, grace=1e9)["after"] == 2
    assert lake.rows() == before and lake.files() == 2


def test_of_two_runs_one_is_refused(spark, lake):
    lake.land(*HOURS)
    before, start = lake.rows(), compaction.snapshot(spark, lake.path)
    compact(spark, lake.path, grace=1e9)
    with pytest.raises(Exception, match="(?i)exist"):  # it began from the same state
        compaction._commit(spark, lake.path, start, "other", start.state)
    assert lake.rows() == before and lake.files() == 2


def test_death_before_the_removal(spark, lake, monkeypatch):
    lake.land(*HOURS)
    before = lake.rows()
    with monkeypatch.context() as patch:
        patch.setattr(compaction, "clean", lambda *_: {})
        compact(spark, lake.path)
    assert lake.rows() == before and lake.files() == 2
    assert compact(spark, lake.path, grace=0, now=4e9) == {"before": 0, "after": 0, "removed": 8}
    assert lake.rows() == before


def test_missing_rows_stop_a_run(spark, lake, monkeypatch):
    lake.land(*HOURS)
    monkeypatch.setattr(compaction, "_local_name", lambda file: F.concat(F.lit("x"), file, F.monotonically_increasing_id().cast("string")))
    with pytest.raises(RuntimeError, match="wrote 0 rows of 8"):
        compact(spark, lake.path, grace=0)
    monkeypatch.undo()
    assert len(lake.rows()) == 8 and lake.files() == 8


def test_bins(spark):
    rows = [("sink", f"a{k}", size, "/d=1") for k, size in enumerate([10, 10, 10, 45, 45, 60, 200])] + [("sink", "b", 1, "/d=2")]
    found = plan(spark.createDataFrame(rows, "kind string, file string, size long, folder string"), 100)
    assert sorted(values(found, "file", "bin")) == [("a0", 0), ("a1", 0), ("a2", 0), ("a3", 0), ("a4", 0)]
    assert plan(spark.createDataFrame([("sink", f"f{k:02d}", 40, "/d=1") for k in range(20)], "kind string, file string, size long, folder string"), 100).groupBy("bin").count().count() >= 7


def test_tables_without_a_log(spark, lake, folder):
    lake.land(HOURS[0])
    assert compact(spark, folder("nothing")) == {"before": 0, "after": 0, "removed": 0}
    assert compact(spark, lake.path) == {"before": 0, "after": 0, "removed": 0}
    assert len(lake.rows()) == 1
