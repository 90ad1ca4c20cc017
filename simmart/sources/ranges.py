"""Tables read in parallel by ranges of a key that hold about as many rows.

Even steps between the least and the greatest id give one task most rows where
ids are skewed. Ranges are cut at quantiles of the key instead, found by Spark's
quantile sketch, so that one row comes to the driver. A range is a condition,
which any reader understands: a database by JDBC or by its Python driver, or a
Parquet table. Keys are whole numbers: other kinds may be ordered in one way by
the database and in another by Spark.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

STEPS = 8  # quantiles in a range
FINER = 4  # how much finer than the quantiles the sketch is
HOT_STEPS = 4  # a value that holds so many quantiles has a range of its own
CHUNK = 10_000


class KeyRange(NamedTuple):
    """Keys above ``low``, or from it on, and up to ``high``, or below it; open
    where there is no bound. Null keys are in one range."""

    low: int | None
    low_in: bool
    high: int | None
    high_in: bool
    nulls: bool = False

    def sql(self, column: str) -> str:
        parts = []
        if self.low is not None:
            parts.append(f"{column} {'>=' if self.low_in else '>'} {self.low}")
        if self.high is not None:
            parts.append(f"{column} {'<=' if self.high_in else '<'} {self.high}")
        text = " AND ".join(parts) or f"{column} IS NOT NULL"
        return f"({text}) OR {column} IS NULL" if self.nulls else text

    def column(self, column: str) -> Column:
        return F.expr(self.sql(f"`{column}`"))


def quantile_ranges(keys: DataFrame, column: str, splits: int) -> list[KeyRange]:
    """Ranges that hold each key once, null in the first, of about a
    ``splits``-th of the rows. One holds at most half as many again, but for a
    value that repeats: if it has half a range's rows or more it has a range
    of its own, and there are more ranges then. Of no rows, one range."""
    if keys.schema[column].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"key {column} is {keys.schema[column].dataType.simpleString()}, not a whole number")
    n = splits * STEPS
    places = [i / n for i in range(1, n)]
    found = keys.agg(F.percentile_approx(column, places, FINER * n).alias("q")).first().q if splits > 1 else None
    ranges: list[KeyRange] = []
    low, low_in, steps = None, False, 0

    def upto(high: int | None, high_in: bool) -> None:
        nonlocal low, low_in, steps
        ranges.append(KeyRange(low, low_in, high, high_in, not ranges))
        low, low_in, steps = high, not high_in, 0

    for value, times in ((v, len(list(same))) for v, same in groupby(found or [])):
        if times >= HOT_STEPS:
            if (low, low_in) != (value, True):
                upto(value, False)
            upto(value, True)
        else:
            steps += times
            if steps >= STEPS:
                upto(value, True)
    upto(None, False)
    return ranges


def read_ranges(df: DataFrame, column: str, ranges: list[KeyRange], number: str) -> DataFrame:
    """The rows of a stored table, each range read by its own condition, with
    the number of the range."""
    return reduce(DataFrame.unionByName, (df.where(r.column(column)).withColumn(number, F.lit(i)) for i, r in enumerate(ranges)))


def jdbc_ranges(spark: SparkSession, url: str, name: str, column: str, ranges: list[KeyRange], **options: str) -> DataFrame:
    """A database table by JDBC, one task for each range."""
    return spark.read.jdbc(url, name, predicates=[r.sql(column) for r in ranges], properties={"fetchsize": str(CHUNK), **options})


class _Range(InputPartition):
    def __init__(self, condition: str):
        super().__init__(condition)


class _KeysetReader(DataSourceReader):
    """Pages of one range: each asks for the rows after the last key, which an
    index finds at once, however far the page; an offset would be counted off."""

    def __init__(self, connect: Callable[[], Any], table: str, columns: list[str], key: str, ranges: list[KeyRange],
                 chunk: int, tries: int, wait: float) -> None:
        self.connect, self.table, self.columns, self.key, self.ranges = connect, table, columns, key, ranges
        self.chunk, self.tries, self.wait = chunk, tries, wait

    def partitions(self) -> list[InputPartition]:
        return [_Range(r.sql(self.key)) for r in self.ranges]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        at, last, done, failed = self.columns.index(self.key), None, False, 0
        connection = None
        while not done:
            try:
                connection = connection or self.connect()
                cursor = connection.cursor()
                cursor.execute(self._page(partition.value, last))
                page = cursor.fetchall()
            except Exception:  # drivers have no common class of errors
                failed, connection = failed + 1, None
                if failed >= self.tries:
                    raise
                time.sleep(self.wait * failed)
                continue
            failed, done = 0, len(page) <= self.chunk
            keys = [row[at] for row in page]
            if None in keys or any(a == b for a, b in zip(keys, keys[1:])):
                raise ValueError(f"key {self.key} of {self.table} is null or repeats: rows would be lost between pages")
            yield from map(tuple, page[: self.chunk])
            last = keys[self.chunk - 1] if not done else None
        connection.close()

    def _page(self, condition: str, last: int | None) -> str:
        """One row more than a page holds tells whether there is a next one,
        and whether the key repeats across the border."""
        after = "" if last is None else f" AND {self.key} > {last}"
        return (
            f"SELECT {', '.join(self.columns)} FROM {self.table} WHERE ({condition}){after} "
            f"ORDER BY {self.key} LIMIT {self.chunk + 1}"
        )


def keyset_table(
    spark: SparkSession,
    connect: Callable[[], Any],
    table: str,
    schema: str,
    key: str,
    ranges: list[KeyRange],
    chunk: int = CHUNK,
    tries: int = 5,
    wait: float = 4.0,
    name: str = "keyset_table",
) -> DataFrame:
    """A database table by its Python driver, one task for each range, which
    holds one page of rows. ``connect`` opens a connection inside a task. The
    key is unique and not null, else the read fails. A page that fails is asked
    for again over a new connection; a task that is lost starts anew."""
    columns = spark.createDataFrame([], schema).columns

    class Keyset(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return _KeysetReader(connect, table, columns, key, ranges, chunk, tries, wait)

    spark.dataSource.register(Keyset)
    return spark.read.format(name).load()


def planned_keyset_table(
    spark: SparkSession, connect: Callable[[], Any], table: str, schema: str, key: str, splits: int, **options: Any
) -> DataFrame:
    """``keyset_table`` in ranges planned from the table's own keys: these alone
    are read first, in even steps between the least and the greatest."""
    connection = connect()
    cursor = connection.cursor()
    cursor.execute(f"SELECT min({key}), max({key}) FROM {table}")
    least, most = cursor.fetchall()[0]
    connection.close()
    if least is None:
        return spark.createDataFrame([], schema)
    step = max(1, -(-(most - least + 1) // splits))
    even = [KeyRange(low, True, low + step, False) for low in range(least, most + 1, step)]
    own = spark.createDataFrame([], schema).schema[key].dataType.simpleString()
    name = options.pop("name", "keyset_table")
    keys = keyset_table(spark, connect, table, f"{key} {own}", key, even, name=f"{name}_keys", **options)
    return keyset_table(spark, connect, table, schema, key, quantile_ranges(keys, key, splits), name=name, **options)
