"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of a text (shares of kinds of characters, words and repeats) are scaled
by the mean and deviation of the labelled texts. Random cosines of them approximate a
Gaussian kernel. Partitions sum their part of the normal equations, whose size depends
on the number of features alone; ridge weights follow from the sum. Scores of labelled
texts that took no part in this are made monotone probabilities by pooling adjacent
violators over a bounded number of score bins, with straight lines between the pools.

Edge cases: a null or empty text has statistics of zero and is scored like any other;
labels that are null or name no document are left out, and repeated labels of one
document are averaged; without labels of both kinds every score is the share of label 1,
or 1 without any label (nothing speaks against a text); a text of any length is read whole
and is one row of statistics; texts of equal statistics have equal scores, and those that
fall on one bin count in it together; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wayprint.llm.scratch import stored
from wayprint.llm.text import slices, span_hashes, utf8, words

N_FOURIER = 256
RIDGE = 1e-3  # per labelled text
BINS = 1024  # of raw scores in a unit
SEED = 20240501

# Kinds of bytes: 0 other, 1 lower case, 2 capital, 3 digit, 4 space, 5 line feed, 6 !, 7 |, 8 other symbol, 9 full stop or comma, 10 not ASCII.
KIND = np.zeros(256, np.int64)
KIND[ord("a"):ord("z") + 1], KIND[ord("A"):ord("Z") + 1], KIND[ord("0"):ord("9") + 1] = 1, 2, 3
KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], KIND[0x0A], KIND[ord("!")], KIND[ord("|")] = 4, 5, 6, 7
KIND[[ord(c) for c in "#*$%&<>"]], KIND[[ord(c) for c in ".,"]], KIND[128:] = 8, 9, 10
N_KINDS = 11
N_STATISTICS = N_KINDS + 9


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of numbers for each text."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    kinds = np.bincount(np.repeat(np.arange(n) * N_KINDS, sizes) + KIND[data], minlength=n * N_KINDS).reshape(n, N_KINDS)
    starts, ends, text = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    n_words = np.bincount(text, minlength=n)

    def per_word(values: np.ndarray, at: np.ndarray = text) -> np.ndarray:
        return np.bincount(at, values, minlength=n) / np.maximum(n_words, 1)

    def repeats(lag: int) -> np.ndarray:
        same = (hashes[lag:] == hashes[:-lag]) & (text[lag:] == text[:-lag])
        return per_word(same, text[lag:])

    length = ends - starts
    mean = per_word(length)
    of_text = hashes ^ (text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    distinct = per_word(np.ones(len(first := np.unique(of_text, return_index=True)[1])), text[first])
    return np.column_stack([
        kinds / np.maximum(sizes, 1)[:, None],
        np.log1p(sizes), np.log1p(n_words), mean, np.sqrt(np.maximum(per_word(length * length) - mean * mean, 0)), distinct,
        repeats(1), repeats(2), per_word(KIND[data[starts]] == 2), (kinds[:, 7] + kinds[:, 8]) / np.maximum(n_words, 1)])


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _array(values: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]).cast(pa.list_(pa.float64()))


def with_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, statistics`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(1)):
                found = statistics(*utf8(batch.column(1).slice(first, last - first)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), _array(found)], names=["doc_id", "statistics"])

    id_type = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(run, f"doc_id {id_type}, statistics array<double>")


@dataclass(frozen=True)
class Model:
    """Everything a score needs; its size does not depend on the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the ridge regression, intercept last
    raw: np.ndarray  # pools of the calibration
    share: np.ndarray

    def features(self, found: np.ndarray) -> np.ndarray:
        random = np.random.default_rng(SEED)
        turn = random.normal(size=(N_STATISTICS, N_FOURIER)) / np.sqrt(N_STATISTICS)
        phase = random.uniform(0, 2 * np.pi, N_FOURIER)
        scaled = np.clip((found - self.mean) / self.scale, -4, 4)
        return np.column_stack([np.sqrt(2 / N_FOURIER) * np.cos(scaled @ turn + phase), np.ones(len(found))])

    def raw_score(self, found: np.ndarray) -> np.ndarray:
        return self.features(found) @ self.weights

    def score(self, found: np.ndarray) -> np.ndarray:
        """The calibrated probability, with a thousandth of the raw score so that pools keep their order."""
        if not self.weights.any():
            return np.full(len(found), self.share[0])
        raw = self.raw_score(found)
        return np.clip(0.999 * np.interp(raw, self.raw, self.share) + 0.001 * np.clip(raw, 0, 1), 0, 1)


def pool(counts: np.ndarray, sums: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of bins whose shares rise, by pooling adjacent violators."""
    ranges: list[list] = []
    for at, (count, total) in enumerate(zip(counts.tolist(), sums.tolist())):
        ranges.append([at, at + 1, count, total])
        while len(ranges) > 1 and ranges[-2][3] * ranges[-1][2] >= ranges[-1][3] * ranges[-2][2]:
            _, end, count, total = ranges.pop()
            ranges[-1][1] = end
            ranges[-1][2] += count
            ranges[-1][3] += total
    return [(a, b) for a, b, *_ in ranges]


def _constant(share: float) -> Model:
    zeros = np.zeros(N_STATISTICS)
    return Model(zeros, zeros + 1, np.zeros(N_FOURIER + 1), np.zeros(1), np.full(1, share))


def fit(labelled: DataFrame) -> Model:
    """The model from ``statistics, label, calibrates`` (label from 0 to 1; calibrating rows fit no weights)."""
    values = [F.col("statistics")[i] for i in range(N_STATISTICS)]
    moments = labelled.agg(
        F.count("label"), F.avg("label"), *[F.avg(v) for v in values], *[F.stddev_pop(v) for v in values]).first()
    n, share = moments[0], moments[1]
    if not n or share in (0, 1):
        return _constant(1.0 if not n else share)
    mean, scale = np.array(moments[2:2 + N_STATISTICS]), np.array(moments[2 + N_STATISTICS:])
    plain = Model(mean, np.where(scale > 1e-9, scale, 1), np.zeros(N_FOURIER + 1), np.zeros(1), np.zeros(1))
    size = N_FOURIER + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if len(batch):
                z = plain.features(_rows(batch.column(0)))
                total[:, :size] += z.T @ z
                total[:, size] += z.T @ batch.column(1).to_numpy()
        if total.any():
            row, column = np.divmod(np.arange(total.size, dtype=np.int32), np.int32(size + 1))
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(column), pa.array(total.ravel())], names=["i", "j", "value"])

    fits = labelled.filter(~F.col("calibrates")).select("statistics", "label")
    summed = fits.mapInArrow(equations, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    found = summed.toArrow()  # as many numbers as the features squared, whatever the corpus
    if not len(found):
        return _constant(share)
    total = np.zeros((size, size + 1))
    total[found["i"].to_numpy(), found["j"].to_numpy()] = found["value"].to_numpy()
    ridge = RIDGE * n * np.eye(size)
    ridge[-1, -1] = 0
    fitted = Model(plain.mean, plain.scale, np.linalg.solve(total[:, :size] + ridge, total[:, size]), plain.raw, plain.share)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                raw = np.clip(fitted.raw_score(_rows(batch.column(0))), -1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.floor(raw * BINS).astype(np.int32)), pa.array(raw), batch.column(1)], names=["bin", "raw", "label"])

    def calibration(rows: DataFrame) -> pa.Table:
        scored = rows.select("statistics", "label").mapInArrow(bins, "bin int, raw double, label double")
        return scored.groupBy("bin").agg(F.count("raw").alias("n"), F.sum("raw").alias("raw"), F.sum("label").alias("label")).orderBy("bin").toArrow()

    table = calibration(labelled.filter("calibrates"))
    if not len(table):
        table = calibration(labelled)
    counts, sums, raws = (table[c].to_numpy() for c in ("n", "label", "raw"))
    pools = pool(counts, sums)
    centres = np.array([raws[a:b].sum() / counts[a:b].sum() for a, b in pools])
    shares = np.array([sums[a:b].sum() / counts[a:b].sum() for a, b in pools])
    return Model(fitted.mean, fitted.scale, fitted.weights, centres, shares)


def remainder(of: int, id_column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % of


def learn(statistics_: DataFrame, labels: DataFrame) -> Model:
    """The model from the labelled documents whose remainder modulo 4 is not 2; remainder 3 calibrates."""
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("label"))
    part = remainder(4)
    rows = statistics_.join(known, "doc_id").filter(part != 2).select("statistics", "label", (part == 3).alias("calibrates"))
    return fit(stored(rows, "labelled"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    found = stored(with_statistics(docs), "statistics")
    model = learn(found, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_rows(batch.column(1))))], names=["doc_id", "score"])

    scored = found.mapInArrow(run, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents, all their columns, that score ``threshold`` or more."""
    model = learn(with_statistics(docs), labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(at)):
                rows = batch.slice(first, last - first)
                yield rows.filter(pa.array(model.score(statistics(*utf8(rows.column(at)))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
