"""Incremental Gold: recompute every touched output partition in full, leave the others alone."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from solvind.functions.calendar import add_time_parts
from solvind.operators.layout import replace_table, stage, write_table
from solvind.operators.pruning import any_of, joined, same_keys, semi_join, value_counts
from solvind.plans.gold import (
    DAY_ROLLUP,
    GOLD_TABLES,
    comparison_from_days,
    condiciones_criticas,
    potencial_solar,
    ranking_from_days,
    read_day_rollup,
    refresh_day_rollup,
    wind_from_days,
    write_day_rollup,
)
from solvind.sources.tables import load_or_empty
from solvind.workspace import delete_folders


def touched_months(new_rows: DataFrame) -> DataFrame:
    """(city, year, month) of newly arrived Silver rows."""
    return add_time_parts(new_rows).select("city", "year", "month").distinct()


# The calendar repeats after 400 years, which have this many days.
CYCLE_YEARS, CYCLE_DAYS = 400, 146_097


def _epoch(month_number: int) -> int:
    """First second of a month, counted from year 0, for any year."""
    year, month = divmod(month_number, 12)
    cycles, within = divmod(year - 2000, CYCLE_YEARS)
    start = dt.datetime(2000 + within, month + 1, 1, tzinfo=dt.timezone.utc).timestamp()
    return int(start) + cycles * CYCLE_DAYS * 86_400


def _month_runs(months: Sequence[Row]) -> list[tuple[int, int]]:
    """Consecutive months as (first, one past last) month numbers."""
    runs: list[tuple[int, int]] = []
    for number in sorted({row["year"] * 12 + row["month"] - 1 for row in months if row["year"] is not None}):
        if runs and runs[-1][1] == number:
            runs[-1] = (runs[-1][0], number + 1)
        else:
            runs.append((number, number + 1))
    return runs


def within_months(silver: DataFrame, months: Sequence[Row]) -> DataFrame:
    """Rows of the listed (year, month). Ranges on `dt` reach the Parquet scan; `year(dt)` comparisons would
    not. The stored month folders are used as well when the table has them."""
    stamp = F.col("dt")
    wanted = [(stamp >= _epoch(first)) & (stamp < _epoch(end)) for first, end in _month_runs(months)]
    if any(row["year"] is None for row in months):
        wanted.append(stamp.isNull())
    rows = silver.filter(joined(wanted))
    return rows.filter(any_of(months, ["year", "month"])) if {"year", "month"} <= set(silver.columns) else rows


def _others(stored: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows whose keys are not among the changed ones."""
    changed = changed.select(*keys).distinct()
    return stored.alias("s").join(changed.alias("c"), same_keys("s", "c", keys), "left_anti")


def only_touched(rows: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    return semi_join(rows, touched.select(*keys).distinct(), keys)


def refresh_gold(silver: DataFrame, root: str, touched: DataFrame) -> dict[str, int]:
    """Update the Gold tables under `root` for the touched (city, year, month); returns rows written.

    Silver is read for the touched site-months only, whatever its age. What reaches further comes from stored
    tables: the ranking, over all years of a touched site, and the untouched sites of a touched month from the day
    rollup, and the other months of a touched site-year of conditions from the table itself. Scans are cut by
    literal month ranges; the semi-join with the touched table then leaves exactly the touched combinations. Silver
    rows may be added and corrected, not removed. A site-year of conditions that a correction leaves without any row
    loses its folder.
    """
    spark = silver.sparkSession
    touched, total = stage(touched.select("city", "year", "month").distinct(), "touched")
    if not total:
        return dict.fromkeys(GOLD_TABLES, 0)
    months = value_counts(touched, ["year", "month"])
    site_month = ("city", "year", "month")

    def store(name: str, rows: DataFrame) -> int:
        return write_table(rows, f"{root}/{name}", GOLD_TABLES[name].partition_by)["rows"]

    started = not load_or_empty(spark, f"{root}/{DAY_ROLLUP}", silver.schema).isEmpty()
    in_site_months = only_touched(add_time_parts(within_months(silver, months)), touched, site_month)
    if started:
        kept = _others(read_day_rollup(spark, root).filter(any_of(months, ["year", "month"])), touched, site_month)
        refresh_day_rollup(in_site_months, kept, root)
    else:
        write_day_rollup(silver, root)
    days = read_day_rollup(spark, root)
    folder = days.filter(any_of(months, ["year", "month"]))

    written = {
        "potencial_solar": store("potencial_solar", potencial_solar(in_site_months)),
        "potencial_eolico": store("potencial_eolico", wind_from_days(only_touched(folder, touched, site_month))),
        "analisis_comparativo": store(
            "analisis_comparativo", comparison_from_days(only_touched(folder, touched, ("year", "month")))
        ),
    }

    critical = condiciones_criticas(in_site_months)
    path = f"{root}/condiciones_criticas"
    same_years = only_touched(load_or_empty(spark, path, critical.schema), touched, ("city", "year"))
    merged, _ = stage(_others(same_years, touched, site_month).unionByName(critical), "critical")
    emptied = _others(same_years.select("city", "year").distinct(), merged, ("city", "year"))
    stale = [f"{path}/city={_folder_name(row.city)}/year={_folder_name(row.year)}" for row in emptied.collect()]
    written["condiciones_criticas"] = store("condiciones_criticas", merged)
    delete_folders(spark, stale)

    # A year in which a site no longer has a listed day must disappear, so the table (at most twenty rows
    # per site) is replaced as a whole.
    ranking = ranking_from_days(only_touched(days, touched, ("city",)))
    path = f"{root}/ranking_dias"
    kept = _others(load_or_empty(spark, path, ranking.schema), touched, ("city",))
    written["ranking_dias"] = replace_table(
        kept.unionByName(ranking), path, GOLD_TABLES["ranking_dias"].partition_by
    )["rows"]
    return written


def _folder_name(value: object) -> str:
    """A partition value as Hive-style folders spell it."""
    return "__HIVE_DEFAULT_PARTITION__" if value is None else "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))


# The characters that partition folders escape.
_ESCAPED = frozenset('"#%\'*/:=?\\{[]^\x7f') | {chr(code) for code in range(1, 32)}
