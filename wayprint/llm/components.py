"""Distributed union-find: the smallest reachable node of every node, from a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wayprint.llm.scratch import discard, stored


def placed(rows: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """Rows of keys with the root of each key's component so far."""
    return rows.join(roots.withColumnRenamed("node", key), key, "left").withColumn("root", F.coalesce("root", key))


def divided(rows: DataFrame, by: str, size: str | None = None) -> DataFrame:
    """Rows of groups that hold several components, with the one that has the most rows as ``main``, and the group's rows as ``size``."""
    counted = rows.groupBy(by, "root").agg(F.count(F.lit(1)).alias("_n"))
    mixed = counted.groupBy(by).agg(
        F.max(F.struct("_n", "root"))["root"].alias("main"), F.count(F.lit(1)).alias("_parts"), F.sum("_n").alias("_rows")).filter("_parts > 1")
    return rows.join(mixed.select(by, "main", *([F.col("_rows").alias(size)] if size else [])), by)


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, root`` for every node of a link; root is the smallest node it is connected with.

    In each round a node takes the smallest root among its neighbours, and then the root
    of that root, so distances halve. A node's neighbours are reduced before they are
    shuffled. Each round is a written table. Without links there are no rows.
    """
    both = links.select(F.col(left).alias("node"), F.col(right).alias("other"))
    both = both.unionByName(links.select(F.col(right).alias("node"), F.col(left).alias("other"))).filter("node <> other").distinct()
    both = stored(both, "links")
    table = roots = stored(both.groupBy("node").agg(F.min("other").alias("root")).select("node", F.least("node", "root").alias("root")), "roots")
    while True:
        offered = both.join(roots.select(F.col("node").alias("other"), "root"), "other").groupBy("node").agg(F.min("root").alias("offer"))
        taken = roots.join(offered, "node").select("node", F.col("root").alias("before"), F.least("root", "offer").alias("root"))
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("further"))
        after = stored(taken.join(jump, "root", "left").select(
            "node", "before", F.least("root", "further").alias("root")), "roots")
        discard(table)
        table, roots = after, after.select("node", "root")
        if after.filter("root <> before").isEmpty():
            discard(both)
            return roots


def united(roots: DataFrame, links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, root`` after further links between roots; a node without a row is its own root.

    Only the roots are joined anew, however many nodes they stand for.
    """
    joined = components(links.select(left, right).distinct(), left, right)
    moved = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("further")), "root", "left")
    moved = moved.select("node", F.coalesce("further", "root").alias("root"))
    return stored(moved.unionByName(joined.join(roots, "node", "left_anti")), "roots")
