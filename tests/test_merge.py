"""Keyed upsert into history."""

import datetime as dt
import os

import pytest

from solvind.operators import merge
from solvind.operators.layout import stage
from solvind.operators.merge import merge_latest, pending_path
from solvind.schemas import HISTORY_TABLE
from solvind.sources import read_table
from solvind.workspace import staging
from tests.support import DEFAULTS, epoch, values

MAY, JUNE = (2024, 5), (2024, 6)


@pytest.fixture
def history(spark, folder):
    class History:
        path = folder("history")

        def rows(self, *changes):
            """Rows of (hour, month, temp, minutes after which it was delivered)."""
            made = []
            for hour, (year, month), temp, minutes in changes:
                at = {**DEFAULTS, "dt": epoch(year, month, 1, hour), "temp": temp, "year": year, "month": month}
                at["ingestion_timestamp"] = None if minutes is None else dt.datetime(2024, 7, 1) + dt.timedelta(minutes=minutes)
                made.append(tuple(at[name] for name in HISTORY_TABLE.fieldNames()))
            return spark.createDataFrame(made, HISTORY_TABLE)

        def merge(self, *changes):
            with staging(spark):
                return merge_latest(stage(self.rows(*changes), "batch")[0], self.path)

        def stored(self):
            rows = values(read_table(spark, self.path, HISTORY_TABLE), "dt", "temp", "month")
            return sorted((dt.datetime.fromtimestamp(at, dt.timezone.utc).hour, temp, month) for at, temp, month in rows)

        def files(self):
            return sorted(f"{folder}/{name}" for folder, _, names in os.walk(self.path) for name in names if name.endswith(".parquet"))

    return History()


def test_corrections_replace_and_new_rows_are_added(history):
    assert history.merge((1, MAY, 10.0, 0), (2, MAY, 11.0, 0), (1, JUNE, 12.0, 0)) == {"rows": 3, "corrected": 0}
    june = [name for name in history.files() if "month=6" in name]
    assert history.merge((2, MAY, 20.0, 5), (3, MAY, 13.0, 5), (2, JUNE, 14.0, 5)) == {"rows": 2, "corrected": 1}
    assert history.stored() == [(1, 10.0, 5), (1, 12.0, 6), (2, 14.0, 6), (2, 20.0, 5), (3, 13.0, 5)]
    assert set(june) < set(history.files())  # no correction there: its file stays
    files = history.files()
    assert history.merge((2, MAY, 20.0, 5), (3, MAY, 13.0, 5), (2, JUNE, 14.0, 9)) == {"rows": 0, "corrected": 0}
    assert history.files() == files and not os.listdir(pending_path(history.path))


def test_older_and_undated_deliveries_change_nothing(history):
    history.merge((1, MAY, 10.0, 5), (2, MAY, 11.0, None))
    assert history.merge((1, MAY, 99.0, 4), (2, MAY, 98.0, None)) == {"rows": 0, "corrected": 0}
    assert history.merge((1, MAY, 97.0, 5)) == {"rows": 0, "corrected": 0}
    assert history.merge((1, MAY, None, 6), (2, MAY, 12.0, 1)) == {"rows": 0, "corrected": 2}
    assert history.stored() == [(1, None, 5), (2, 12.0, 5)]
    assert history.merge() == {"rows": 0, "corrected": 0}


def test_a_rewrite_that_died_is_finished(spark, history, monkeypatch):
    history.merge((1, MAY, 10.0, 0), (2, MAY, 11.0, 0), (1, JUNE, 12.0, 0))

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(merge, "_swap_in", die)
        with pytest.raises(KeyboardInterrupt):
            history.merge((1, MAY, 30.0, 5), (4, JUNE, 15.0, 5))
    for name in history.files():  # as if it died when the old month was gone and the new one not there
        if "month=5" in name:
            os.remove(name)
    assert history.merge((1, MAY, 30.0, 5), (4, JUNE, 15.0, 5)) == {"rows": 1, "corrected": 0}
    assert history.stored() == [(1, 12.0, 6), (1, 30.0, 5), (2, 11.0, 5), (4, 15.0, 6)]
    os.makedirs(f"{pending_path(history.path)}/half")  # one that died while it was being written
    assert history.merge((1, MAY, 30.0, 5)) == {"rows": 0, "corrected": 0}
    assert not os.listdir(pending_path(history.path)) and len(history.stored()) == 4
