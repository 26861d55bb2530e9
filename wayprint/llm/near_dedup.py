"""Near-duplicate documents by min-max hashing of word shingles.

A signature keeps the smallest and the largest value of each permutation, so that it
takes half the hash evaluations of a signature of minimums alone. Bands of it put
documents into buckets; two documents at the threshold miss each other in all bands
with a chance of about 3 in a million.

1. Documents with one and the same set of shingles are a class; only classes go on.
2. Each bucket has a pivot, drawn by a hash. Every member is compared with its buckets'
   pivots on full sets. A group of n near copies costs about n comparisons a band.
3. Linked classes are joined by a distributed union-find. Where a bucket's members are
   then still in several components, they are compared with the member that has the
   most links, and joined again.
4. What is left in such buckets is decided by prefix filtering, which loses no link: with
   the shingles of each set in one order, rare ones first, two sets at the threshold
   have one in common among the first few. Only pairs that have one, and are in
   different components, are compared. The many copies of a text share just common
   shingles, and stay out of each other's way.

Words are maximal runs of other characters than ``[\\x20\\x09-\\x0D]``, with A-Z in lower
case; shingles and sets are compared as hashes of 64 and 128 bits.

Edge cases: a null or empty text has no shingles and is linked with nothing; a text of
fewer words than a shingle is one shingle; rows with one id are one document; rows
without an id keep to themselves unless their text is that of another row; all words of a
text of any length count; a similarity equal to the threshold is a link; an empty
table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayprint.llm.components import components, divided, placed
from wayprint.llm.scratch import discard, stored
from wayprint.llm.text import LOWER, mix, slices, span_hashes, utf8, words

N_BANDS = 24
PER_BAND = 2  # permutations in a band, each with its minimum and its maximum
_random = np.random.default_rng(11)
FACTORS = _random.integers(0, 1 << 32, (N_BANDS, PER_BAND), dtype=np.uint32) | np.uint32(1)
MASKS = _random.integers(0, 1 << 32, (N_BANDS, PER_BAND), dtype=np.uint32)
STEP, SECOND = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, text by text, and the offsets of texts in them."""
    data = LOWER[data]
    starts, ends, text = words(data, offsets)
    hashes, n = span_hashes(data, starts, ends), len(offsets) - 1
    n_words = np.bincount(text, minlength=n)
    last = np.cumsum(n_words)
    sums, length = np.zeros(len(hashes), np.uint64), np.minimum(n_words, size)[text]
    for at in range(size):
        inside = np.flatnonzero(np.arange(at, len(hashes) + at) < last[text])
        sums[inside] = sums[inside] * STEP + hashes[inside + at]
    place = np.arange(len(hashes)) - (last - n_words)[text]
    begins = place <= np.maximum(n_words[text] - size, 0)
    found = mix(sums + length.astype(np.uint64))[begins]
    counts = np.where(n_words > 0, np.maximum(n_words - size + 1, 1), 0)
    return found, np.concatenate([[0], np.cumsum(counts)])


def key_of(distinct: np.ndarray) -> bytes:
    """128 bits that depend on the members of a set alone."""
    return distinct.sum(dtype=np.uint64).tobytes() + mix(distinct ^ SECOND).sum(dtype=np.uint64).tobytes()


def band_hashes(found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A number for each text with shingles and band, from minimums and maximums."""
    values = (found >> np.uint64(32)).astype(np.uint32)
    starts = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(starts), N_BANDS), np.uint64)
    for band in range(N_BANDS):
        total = np.full(len(starts), band + 1, np.uint64)
        for mask, factor in zip(MASKS[band], FACTORS[band]):
            permuted = (values ^ mask) * factor
            for reduced in (np.minimum.reduceat(permuted, starts), np.maximum.reduceat(permuted, starts)):
                total = mix(total * STEP + reduced.astype(np.uint64))
        out[:, band] = total
    return out


def sketches(docs: DataFrame, size: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, key, bands``; key and bands are null without shingles."""
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(1)):
                part = batch.slice(first, last - first)
                found, offsets = shingles(*utf8(part.column(1)), size)
                sets = [np.unique(found[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                bands = iter(band_hashes(found, offsets).view(np.int64) if len(found) else ())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(map(len, sets), pa.int64()),
                    pa.array([key_of(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "key", "bands"])

    return docs.select(id_column, text_column).mapInArrow(run, f"doc_id {id_type}, n_shingles long, key binary, bands array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, size: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``key, members`` for each wanted ``key, first_id``: the set's hashes in rising order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(1)):
                part = batch.slice(first, last - first)
                found, offsets = shingles(*utf8(part.column(1)), size)
                keys, members = [], []
                for key, a, b in zip(part.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    members_ = np.unique(found[a:b])
                    if key_of(members_) == key:  # another row of the same id may have another text
                        keys.append(key), members.append(members_.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(members, pa.binary())], names=["key", "members"])

    texts = docs.select(F.col(id_column).alias("first_id"), F.col(text_column).alias("text"))
    rows = wanted.join(texts, wanted["first_id"].eqNullSafe(texts["first_id"])).select("key", "text")
    # Repeated rows give a set again.
    return rows.mapInArrow(run, "key binary, members binary").dropDuplicates(["key"])


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, both, any``: sizes of intersection and union of the full sets of each pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, either = [], []
            for left, right in zip(batch.column(2), batch.column(3)):
                left, right = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                both.append(len(np.intersect1d(left, right, assume_unique=True)))
                either.append(len(left) + len(right) - both[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, pa.int64()), pa.array(either, pa.int64())], names=["a", "b", "both", "any"])

    left = sets.select(F.col("key").alias("a"), F.col("members").alias("a_members"))
    right = sets.select(F.col("key").alias("b"), F.col("members").alias("b_members"))
    rows = pairs.join(left, "a").join(right, "b")
    return rows.select("a", "b", "a_members", "b_members").mapInArrow(run, "a binary, b binary, both long, any long")


def _pairs(rows: DataFrame, left: str, right: str) -> DataFrame:
    return rows.filter(F.col(left) != F.col(right)).select(
        F.least(left, right).alias("a"), F.greatest(left, right).alias("b")).distinct()


def rarest(sets: DataFrame, percent: int) -> DataFrame:
    """``key, rest, n, shingle``: so many of each set's rarest shingles that sets at the threshold have one in common; ``rest`` counts it and those after it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, members in zip(batch.column("key"), batch.column("members")):
                found = np.frombuffer(members.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key.as_py()] * len(found), pa.binary()), pa.array(np.full(len(found), len(found))), pa.array(found)], names=["key", "n", "shingle"])

    rows = sets.select("key", "members").mapInArrow(run, "key binary, n long, shingle long")
    rows = stored(rows, "shingles")
    held = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("held"))
    ordered = rows.join(held, "shingle").groupBy("key", "n").agg(F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("found"))
    few = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return ordered.select("key", "n", F.posexplode(F.slice("found", F.lit(1), few.cast("int"))).alias("at", "x")).select(
        "key", (F.col("n") - F.col("at")).alias("rest"), "n", "x.shingle")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, **columns: str) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    Two documents are linked when 100 times their common shingles are at least
    ``percent`` times all their shingles.
    """
    found = stored(sketches(docs, size, **columns), "sketches")
    classes = stored(found.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n")), "classes")
    rows = classes.select("key", "n", F.explode("bands").alias("bucket"))
    drawn = F.min(F.struct(F.xxhash64("key", "bucket").alias("draw"), "key"))["key"]
    buckets = rows.groupBy("bucket").agg(drawn.alias("pivot"), F.count(F.lit(1)).alias("size")).filter("size > 1").drop("size")
    members = stored(rows.join(buckets, "bucket"), "members")
    pairs = stored(_pairs(members, "key", "pivot"), "pairs")
    wanted = members.select("key").distinct().join(classes.select("key", "first_id"), "key")
    sets = stored(sets_of(docs, wanted, size, **columns), "sets")
    compared = stored(compare(pairs, sets), "compared")
    is_link = 100 * F.col("both") >= percent * F.col("any")
    discard(pairs)
    links = compared.filter(is_link).select("a", "b")
    roots = components(links)

    # Members of divided buckets against the best linked one of each.
    degree = links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("degree"))
    parted = stored(divided(placed(members, roots, "key"), "bucket").join(degree, "key", "left"), "parted")
    hubs = parted.groupBy("bucket").agg(F.max(F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), "key", "root")).alias("hub"))
    to_hub = parted.join(hubs, "bucket").filter("root <> hub.root").select("key", F.col("hub.key").alias("pivot"))
    to_hub = _pairs(to_hub, "key", "pivot").join(compared.select("a", "b"), ["a", "b"], "left_anti")
    second = stored(compare(stored(to_hub, "pairs"), sets), "compared")
    if not (further := second.filter(is_link).select("a", "b")).isEmpty():
        links = links.unionByName(further)
        roots = components(links)

    # Members of buckets that are divided even so, by their rarest shingles.
    keys = divided(placed(parted.select("bucket", "key", "n"), roots, "key"), "bucket").select("key").distinct()
    prefixes = stored(placed(rarest(sets.join(keys, "key"), percent), roots, "key"), "prefixes")
    rows = divided(prefixes, "shingle")
    outside = rows.filter("root <> main").select("shingle", F.col("key").alias("x"), F.col("n").alias("x_n"), F.col("rest").alias("x_rest"), F.col("root").alias("x_root"))
    more = outside.join(rows, "shingle").filter(
        (F.col("root") != F.col("x_root")) & ((F.col("root") == F.col("main")) | (F.col("x") < F.col("key")))
        # The first one in common leaves enough for the least intersection that makes a link.
        & ((100 + percent) * F.least("rest", "x_rest") >= percent * (F.col("n") + F.col("x_n"))))
    more = _pairs(more, "x", "key").join(compared.select("a", "b").unionByName(second.select("a", "b")), ["a", "b"], "left_anti")
    third = stored(compare(stored(more, "pairs"), sets), "compared").filter(is_link).select("a", "b")
    if not third.isEmpty():
        roots = components(links.unionByName(third))
    discard(members, sets, parted, prefixes)

    of_class = classes.select("key", "first_id").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    first = of_class.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = of_class.join(first, "root").select("key", "component_id")
    return found.join(of_class, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all their columns, less all but the first of each group of near duplicates."""
    kept = near_duplicates(docs, size, percent).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")
