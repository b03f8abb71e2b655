"""Facts about a batch, bounded by the calendar, that let the next scan skip partitions."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence
from operator import or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def value_counts(df: DataFrame, columns: Sequence[str]) -> list[Row]:
    """Rows per combination of calendar columns (`_rows`). Observation times are limited to plausible ones before
    they get here, so there are as many combinations as the lake has months, whatever its number of rows."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows")).collect()


def joined(parts: Sequence[Column], operator: Callable[[Column, Column], Column] = or_) -> Column:
    """Conditions in a balanced tree: its depth is the logarithm of their number."""
    parts = list(parts) or [F.lit(False)]
    while len(parts) > 1:
        parts = [operator(*parts[at : at + 2]) if at + 1 < len(parts) else parts[at] for at in range(0, len(parts), 2)]
    return parts[0]


def _one_of(name: str, values: Sequence[object]) -> Column:
    listed = F.col(name).isin([value for value in values if value is not None])
    return listed | F.col(name).isNull() if None in values else listed


def any_of(rows: Sequence[Row], columns: Sequence[str]) -> Column:
    """Predicate for the listed combinations; on partition columns it prunes folders.

    Values of the first column that go with the same values of the others share one term, so years with the same
    months, as most years have, are one list."""
    return _any_of(sorted({tuple(row[name] for name in columns) for row in rows}, key=repr), columns)


def _any_of(values: Sequence[tuple], columns: Sequence[str]) -> Column:
    if len(columns) == 1:
        return _one_of(columns[0], [value for (value,) in values])
    rest: dict[object, list[tuple]] = defaultdict(list)
    for first, *others in values:
        rest[first].append(tuple(others))
    alike: dict[tuple, list[object]] = defaultdict(list)
    for first, others in rest.items():
        alike[tuple(others)].append(first)
    return joined([_one_of(columns[0], firsts) & _any_of(others, columns[1:]) for others, firsts in alike.items()])


def same_keys(left: str, right: str, keys: Sequence[str]) -> list[Column]:
    """Null-safe key equality between two aliased frames."""
    return [F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}")) for key in keys]


def semi_join(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `df` whose keys occur in `wanted`. Pass a stored table: its size decides whether it is broadcast."""
    return df.alias("l").join(wanted.select(*keys).alias("r"), same_keys("l", "r", keys), "left_semi")
