"""Joins of events with the tables that say whose they are."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wayprint.functions import present


def attach(df: DataFrame, other: DataFrame, on: dict[str, str], require: Iterable[str] = ()) -> DataFrame:
    """Left outer equi-join; ``on`` maps columns of ``df`` to columns of ``other``.

    Rows where a ``require`` column is null afterwards are dropped. When such a
    column comes from ``other``, Spark plans the join as an inner join and
    filters both sides before the shuffle. There are no hints: the join type
    follows the sizes Spark measures, and a hot key is split at run time. Numbers are
    compared as numbers, whatever their types, and a number with text as text.
    """
    renamed = {right: f"_{right}" for right in on.values()}
    other = other.withColumnsRenamed(renamed)
    condition = [_same(df, left, other, renamed[right]) for left, right in on.items()]
    joined = df.join(other, condition, "left_outer").drop(*renamed.values())
    required = list(require)
    return joined.filter(present(*required)) if required else joined


HOST = r"^[^:/]+://[^/]+"


def prefix_lookup(df: DataFrame, url: str, prefixes: DataFrame, out: str) -> DataFrame:
    """``df`` with the id of the longest prefix of its URL, from a table ``prefix, id``.

    A prefix names a whole scheme and host and may go on with any text. Each distinct
    URL is cut at the lengths that prefixes of its host have, and the cuts meet the
    prefixes in an equi-join; of the hits the longest stays. So the work grows with the
    different lengths a host has, which URLs bound, and not with the number of its
    prefixes, and every table is spread by whole URLs or prefixes. Of a prefix given
    several times the greatest id counts.
    """
    known = prefixes.filter(present("prefix")).withColumn("_host", F.regexp_extract("prefix", HOST, 0)).filter("_host <> ''")
    known = known.groupBy("_host", "prefix").agg(F.max("id").alias("id"))
    lengths = known.groupBy("_host").agg(F.collect_set(F.length("prefix")).alias("_lengths"))
    urls = df.select(F.col(url).alias("_url")).filter(present("_url")).distinct()
    urls = attach(urls.withColumn("_of", F.regexp_extract("_url", HOST, 0)), lengths, {"_of": "_host"}, require=["_lengths"])
    fitting = F.filter("_lengths", lambda n: n <= F.length("_url"))
    cuts = urls.select("_url", F.explode(F.transform(fitting, lambda n: F.substring(F.col("_url"), F.lit(1), n))).alias("_cut"))
    hits = attach(cuts, known.select("prefix", "id"), {"_cut": "prefix"}, require=["id"])
    longest = hits.groupBy("_url").agg(F.max_by("id", F.length("_cut")).alias("_hit"))
    found = attach(df, longest.withColumnRenamed("_url", "_found"), {url: "_found"})
    return found.drop(out).withColumnRenamed("_hit", out)


# Keys that are broadcast at most: some tens of megabytes.
MOST_KEYS = 1_000_000


def only_keys(df: DataFrame, some: DataFrame, key: str, most: int = MOST_KEYS) -> DataFrame:
    """Rows of a large table whose key is among those of a span of days.

    The distinct keys are counted while the plan is built, up to ``most``. So many
    are broadcast, and the table is filtered where it is scanned; with more keys
    than that the span is no small part, and Spark joins as it sees fit.
    """
    keys = some.filter(present(key)).select(F.col(key).alias("_key")).distinct()
    if keys.limit(most + 1).count() <= most:
        keys = F.broadcast(keys)
    return df.join(keys, _same(df, key, keys, "_key"), "left_semi")


def _same(left: DataFrame, a: str, right: DataFrame, b: str) -> Column:
    one, other = left.schema[a].dataType, right.schema[b].dataType
    if one == other or isinstance(one, T.NumericType) and isinstance(other, T.NumericType):
        return left[a] == right[b]
    return left[a].cast("string") == right[b].cast("string")


def paired_count_by(left: DataFrame, right: DataFrame, keys: Iterable[str], out: str) -> DataFrame:
    """Count per key of ``right`` after joining every left row with every right row.

    No pair is formed: each key occurs as often as it does on the right, times
    the number of left rows, which enters as a scalar subquery.
    """
    left_rows = left.select(F.count(F.lit(1)).alias("n")).scalar()
    keys = list(keys)
    return (
        right.filter(present(*keys)).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(out))
        .withColumn(out, F.col(out) * left_rows)
        .filter(F.col(out) > 0)
    )
