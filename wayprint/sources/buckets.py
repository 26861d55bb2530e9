"""Source tables kept in buckets of their join keys, for daily runs at any size.

A day's lines meet the order header, the card bindings and the transfer products. Where
these full tables are bucketed and sorted by the key of that join, each bucket is read
by the task that joins it: only the day is shuffled, however many keys it has, and no
key is counted, collected or broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from wayprint.sources.registry import Loader, Registry
from wayprint.sources.schemas import COLUMNS

# Full tables that daily runs join with, and the key of that join.
BUCKET_KEYS = {
    "tb_order": "order_no", "tb_order_cip": "order_no", "tb_order_vvip": "order_no", "tb_order_limousine": "order_no",
    "tb_bindrecord": "dragoncode",
}


def write_buckets(registry: Registry, database: str, buckets: int, root: str | None = None, names: Iterable[str] = tuple(BUCKET_KEYS)) -> None:
    """Writes tables as bucketed, sorted tables of the session's catalog, under ``root`` if given.

    One exchange each: rows go to the task of their bucket, which writes one file. Take
    at least as many buckets as the joins have shuffle partitions, or else Spark may
    prefer to shuffle both sides.
    """
    registry.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in names:
        key = BUCKET_KEYS[name]
        rows = registry.table(name).repartition(buckets, key)
        writer = rows.write.bucketBy(buckets, key).sortBy(key).format("parquet").mode("overwrite")
        if root:
            writer = writer.option("path", f"{root.rstrip('/')}/{name}")
        writer.saveAsTable(f"`{database}`.`{name}`")


def bucketed_database(database: str, others: Loader) -> Loader:
    """Loader of the bucketed tables of a database, and of all others by ``others``."""
    def load(spark: SparkSession, table: str):
        known = table in BUCKET_KEYS and spark.catalog.tableExists(f"`{database}`.`{table}`")
        return spark.table(f"`{database}`.`{table}`") if known else others(spark, table)

    return load


def bucketed_registry(spark: SparkSession, database: str, others: Loader) -> Registry:
    """A registry that knows which of its tables are bucketed by their join keys."""
    layout = {name: key for name, key in BUCKET_KEYS.items() if spark.catalog.tableExists(f"`{database}`.`{name}`")}
    assert all(key in COLUMNS[name] for name, key in layout.items())
    return Registry(spark, bucketed_database(database, others), layout)
