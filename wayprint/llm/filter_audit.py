"""Filter interaction audit: what each filter removes in every order of the filters.

A document is reduced to the mask of the filters that it fails, and documents are
counted by part and mask: at most two to the number of filters groups a part. An
order is a permutation, numbered by its Lehmer rank, which is its place among all
permutations in lexicographic order. A mask is removed at step k by the orders whose
first k - 1 filters it passes and whose k-th it fails; orders with the same first k
filters are one interval of ranks. So each count is added where an interval begins and
taken off where it ends, and a prefix sum over the ranks gives what every order
removes at that step.

Edge cases: a null text is an empty one (few words, and equal to other empty texts); a
null part is the empty string; of equal texts those with the smallest id fail no
duplicate filter, all of them where the id repeats, and rows without an id neither fail
it nor count as smaller; repeated rows count each; labels of one document given
several times count as set if any is; texts of any length are measured whole; an empty
table has no parts and gives no rows; other columns of the inputs are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window, functions as F

GAP = r"[\x20\x09-\x0D]+"
MEASURES = ("n", "good", "toxic")


# Filters A to D over the measurements of a text: whether it fails each.
TEXT_FILTERS = {
    "A": "n_words < 50",
    "B": "100 * n_distinct < 65 * n_words",
    "C": "100 * n_capitals > 5 * n_chars",
    "D": "has_symbol",
}


def _measured(rows: DataFrame) -> DataFrame:
    """Measurements of ``text``, each taken once; the text itself goes."""
    others = [c for c in rows.columns if c != "text"]
    split = rows.select("*", F.array_remove(F.split("text", GAP), "").alias("words"))
    return split.select(
        *others, F.unhex(F.sha2("text", 256)).alias("digest"), F.size("words").cast("bigint").alias("n_words"),
        F.size(F.array_distinct("words")).cast("bigint").alias("n_distinct"), F.length("text").cast("bigint").alias("n_chars"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("n_capitals"), F.col("text").rlike(r"[#$%&*|]").alias("has_symbol"))


def _mask() -> Column:
    """One number with bit i set where the i-th text filter fails."""
    mask = F.lit(0)
    for i, broken in enumerate(TEXT_FILTERS.values()):
        mask = mask + F.when(F.expr(broken), F.lit(1 << i)).otherwise(0)
    return mask


def masks(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and the filters A to E that they fail.

    Rows of one document and text are counted first, so that neither the join with the
    labels nor the comparison of equal texts meets a hot key: what is compared by text
    afterwards is at most a row for each part, mask and label of that text.
    """
    rows = _measured(docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text")))
    rows = rows.groupBy("doc_id", "part", "digest", _mask().alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # Rows without an id match nothing; a second key spreads them.
    rows = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.hash("digest")).otherwise(0))
    marks = marks.withColumn("spread", F.lit(0))
    rows = rows.join(marks, ["doc_id", "spread"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    same = ["digest", "part", "mask", "good", "toxic"]
    texts = rows.groupBy(*same).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least"))
    least = F.min("least").over(Window.partitionBy("digest"))
    stays = F.col("nameless") + F.when(F.col("least") == least, F.col("n_least")).otherwise(0)
    texts = texts.withColumn("stays", stays).select(*same[1:], "n", "stays")
    each = F.explode(F.array(
        F.struct(F.col("mask"), F.col("stays").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("stays")).alias("n"))))
    counted = texts.select("part", "good", "toxic", each.alias("c")).filter("c.n > 0")
    return counted.groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum("c.n").alias("n"), *[F.sum(F.col("c.n") * F.col(c)).alias(c) for c in MEASURES[1:]])


def steps(filters: str) -> list[tuple]:
    """``rank, filter_order, step, letter, place`` of every step of every order; place is the filter's, from 0."""
    orders = ["".join(p) for p in permutations(sorted(filters))]
    return [(rank, order, step, order[step - 1], filters.index(order[step - 1]))
            for rank, order in enumerate(orders) for step in range(1, len(filters) + 1)]


def intervals(filters: str) -> list[tuple[int, int, int, int]]:
    """``mask, step, rank, sign``: where the orders that remove a mask at a step begin (1) and end (-1)."""
    letters, n, out = sorted(filters), len(filters), []

    def extend(used: str, passed: int, first: int) -> None:
        """All masks that the filters ``used`` let pass, removed by the next one; ``first`` is the prefix's rank."""
        width = factorial(n - len(used) - 1)
        for place, letter in enumerate(x for x in letters if x not in used):
            bit, start = 1 << filters.index(letter), first + place * width
            for mask in range(1 << n):
                if mask & bit and not mask & passed:
                    out.append((mask, len(used) + 1, start, 1))
                    out.append((mask, len(used) + 1, start + width, -1))
            if len(used) + 1 < n:
                extend(used + letter, passed | bit, start)

    extend("", 0, 0)
    return out


def audit(counts: DataFrame, filters: str) -> DataFrame:
    """One row for each part, order and step from ``part, mask`` and the counts of :func:`masks`.

    ``kept`` documents remain after the step and ``removed`` ones go here; ``redundant``
    fail its filter but went earlier, ``unique_fails`` fail no other filter. ``good_lost``
    and ``toxic_lost`` are labelled ones among the removed. ``shapley`` is what the filter
    removes in all orders together.
    """
    spark = counts.sparkSession
    ends = spark.createDataFrame(intervals(filters), "mask int, step int, rank int, sign int")
    grid = spark.createDataFrame(steps(filters), "rank int, filter_order string, step int, letter string, place int")
    bits = range(len(filters))
    totals = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0)) for i in bits]).alias("fails"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in bits]).alias("alone"))
    # A row of zeros at every rank, so that the sums have a value everywhere.
    zeros = totals.select("part", F.explode(F.array(*[F.lit(s) for s in range(1, len(filters) + 1)])).alias("step"))
    zeros = zeros.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(factorial(len(filters)) - 1))).alias("rank"))
    changes = counts.withColumn("mask", F.col("mask").cast("int")).join(F.broadcast(ends), "mask")
    changes = changes.select("part", "step", "rank", *[(F.col(c) * F.col("sign")).alias(c) for c in MEASURES])
    changes = changes.unionByName(zeros.select("*", *[F.lit(0).cast("bigint").alias(c) for c in MEASURES]))
    changes = changes.groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in MEASURES])
    upto = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    removed = changes.select("part", "step", "rank", *[F.sum(c).over(upto).alias(c) for c in MEASURES])
    rows = removed.join(F.broadcast(grid), ["rank", "step"]).join(totals, "part")
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("gone", F.sum("n").over(so_far)).withColumn("shapley", F.sum("n").over(Window.partitionBy("part", "letter")))
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), F.col("n").alias("removed"),
        (F.get("fails", F.col("place")) - F.col("n")).alias("redundant"), F.get("alone", F.col("place")).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")


def audit_documents(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The audit of filters A to E over all documents."""
    return audit(masks(docs, labels, **columns), "ABCDE")
