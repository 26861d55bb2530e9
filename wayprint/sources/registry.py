"""Source tables by name, each routed to the database that holds it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wayprint.operators.joins import only_keys
from wayprint.sources.schemas import COLUMNS, DATABASE, POSITIONS

Loader = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Split:
    """How to read one database table in parallel: ranges of a numeric or time column."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int


def parquet_directory(path: str, suffix: str = ".parquet") -> Loader:
    return lambda spark, table: spark.read.parquet(f"{path}/{table}{suffix}")


# Reads a table by one task; for small tables only.
ONE_TASK = "one task"


def jdbc_database(url: str, properties: Mapping[str, str], splits: Mapping[str, Split | list[str] | str]) -> Loader:
    """Tables of a database, each read as ``splits`` says.

    A :class:`Split` gives ranges of a numeric or time column. A list of SQL
    conditions, for tables with text keys, gives a task for each; together they must
    hold for every row once. ``ONE_TASK`` has to be asked for: a table without an
    entry is an error, as one task would read all of it.
    """
    splits = dict(splits)

    def load(spark: SparkSession, table: str) -> DataFrame:
        split = splits.get(table)
        if split is None:
            raise ValueError(f"no split for {table}: give ranges, conditions or ONE_TASK")
        if split == ONE_TASK:
            return spark.read.jdbc(url, table, properties=dict(properties))
        if isinstance(split, list):
            return spark.read.jdbc(url, table, predicates=split, properties=dict(properties))
        return spark.read.jdbc(
            url, table, column=split.column, lowerBound=split.lower, upperBound=split.upper,
            numPartitions=split.partitions, properties=dict(properties),
        )

    return load


def frames(tables: Mapping[str, DataFrame]) -> Loader:
    return lambda spark, table: tables[table]


class Registry:
    """Gives each source table with the declared columns, by name.

    ``databases`` maps the logical names ``business``, ``business2`` and ``log``
    to loaders; one loader may serve all three. ``layout`` names the join key by which
    tables are bucketed, where they are (:mod:`wayprint.sources.buckets`).
    """

    def __init__(self, spark: SparkSession, databases: Mapping[str, Loader] | Loader, layout: Mapping[str, str] | None = None):
        self.spark, self._layout = spark, dict(layout or {})
        if callable(databases):
            databases = {name: databases for name in set(DATABASE.values())}
        self._databases = dict(databases)
        self._tables: dict[str, DataFrame] = {}

    def laid_out(self, *names: str) -> bool:
        """Whether all these tables are bucketed by their join keys."""
        return all(name in self._layout for name in names)

    def narrowed(self, name: str, some: DataFrame, key: str) -> DataFrame:
        """A table for an inner join by ``key`` with the rows of a span of days.

        A table that is bucketed by the key is read bucket by bucket in the join and
        needs no narrowing; of another one only the span's keys are kept.
        """
        full = self.table(name)
        return full if self._layout.get(name) == key else only_keys(full, some, key)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            raw = self._databases[DATABASE[name]](self.spark, name)
            types = {field.name: field.dataType.simpleString() for field in raw.schema}
            self._tables[name] = raw.selectExpr(*[
                _source_column(types, name, column, kind) for column, kind in COLUMNS[name].items()
            ])
        return self._tables[name]


def _source_column(types: dict[str, str], table: str, column: str, kind: str | None) -> str:
    source = column
    position = POSITIONS.get(table, {}).get(column)
    if position is not None and column not in types:
        source = list(types)[position]
    value = f"`{source}`"
    if kind is not None and types.get(source) != kind:
        value = f"cast({value} as {kind})"
    return f"{value} as `{column}`"
