"""Packing: documents cut into pieces that fill sequences of a fixed number of tokens.

Each document is its token ids and an end id. Whole windows of a long document are
sequences by themselves. What remains of it is a piece to be combined with others;
of some rows it is cut into grains of halving sizes, which even out the rest. How many
rows that takes follows from the counted lengths: so many that no more pieces above a
half, a third and so on of a window are left than the windows hold one, two and so on of.
Pieces meet in groups of many windows. In each, Karmarkar-Karp multiway differencing
divides them over windows: every piece is a partial partition, and the two partial
partitions with the largest differences are merged with opposing order, large
against small, until one is left. When a window holds more than its capacity, the
number of windows rises.

Edge cases: a null or empty text is the end id alone; a repeated row is packed
again; rows with a null id are packed alike; a text of any length is encoded whole, and its
full windows are sequences of their own; which of two equal pieces goes where is fixed by
their ids, starts and checksums; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import os
import re
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayprint.llm.scratch import stored
from wayprint.llm.text import slices

CACHE_SIZE = 600_000  # words whose ids a worker keeps, whatever the input
GROUP_PIECES = 1500  # pieces that one differencing divides, on average
GROUP_WINDOWS = 64  # windows that a group fills at least, however small its pieces
PARTS_OF = 64  # shares of rows are counted in so many parts
LEAST_CUT = 4  # parts of the rows that lend their remainders as grains in any case
SHARES = 8  # pieces above one in so many of a window are cut as the lengths demand
SLACK = 0.97  # of the windows, for pieces that leave no whole place
TRIAL, PADDING = 600, 0.02  # rows of a trial, and the padding it may have
WHITES = "\n\t\r"  # and the space; other white space is part of a word here
# Words of ASCII (less the apostrophe) and Latin-1 letters skip the tokenizer's normalizer: they have one
# normal form and one lower case, and their parts are runs of letters, single digits and runs of the rest.
PLAIN = re.compile("[!-&(-~À-ÖØ-öø-ÿ]+").fullmatch
PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+").findall


def _byte_letters() -> dict[int, str]:
    """How byte-level models write the UTF-8 bytes of Latin-1 letters: printable bytes as themselves, the others from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in printable)
    shown = {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(rest)}
    return {c: "".join(shown[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


BYTE_LETTERS = _byte_letters()


class WordEncoder:
    """Ids of texts by way of their words; white space never matters to this kind of tokenizer."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task on each core
        self.tokenizer, self.known, self.parts = Tokenizer.from_str(tokenizer_json), {}, {}
        self.merge = self.tokenizer.model.tokenize

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian 32-bit numbers."""
        for white in WHITES:
            texts = [text.replace(white, " ") for text in texts]
        cut = [text.split(" ") for text in texts]
        fresh = set().union(*cut).difference(self.known)  # looks up the words; keys() would be gone through whole
        if len(self.known) + len(fresh) > CACHE_SIZE:
            self.known, self.parts, fresh = {}, {}, set().union(*cut)
        plain = [word for word in fresh if PLAIN(word) and "<|" not in word]
        for word in plain:
            self.known[word] = b"".join(map(self.part, PARTS(word.lower())))
        fresh = list(fresh.difference(plain))
        for word, found in zip(fresh, self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)):
            self.known[word] = array("I", found.ids).tobytes()
        find = self.known.__getitem__
        return [b"".join(map(find, words)) for words in cut]

    def part(self, text: str) -> bytes:
        """Ids of a part that the tokenizer would merge by itself."""
        found = self.parts.get(text)
        if found is None:
            shown = text if text.isascii() else text.translate(BYTE_LETTERS)
            found = self.parts[text] = array("I", [token.id for token in self.merge(shown)]).tobytes()
        return found


_workers: dict[int, WordEncoder] = {}


def _worker(key: int, tokenizer_json: str) -> WordEncoder:
    if key not in _workers:
        _workers.clear()
        _workers[key] = WordEncoder(tokenizer_json)
    return _workers[key]


def grains(rest: int) -> list[int]:
    """Lengths that a remainder is cut into."""
    found = []
    while rest > 1:
        found.append((rest + 1) // 2)
        rest //= 2
    return found + [rest] * (rest > 0)


def fewest(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Windows that so many pieces of these lengths need: by their sum, and as one holds k pieces above its (k + 1)th part."""
    large = [-(-int(counts[lengths * (k + 1) > capacity].sum()) // k) for k in range(1, SHARES)]
    return max(1, -(-int((lengths * counts).sum()) // capacity), *large)


def cut_parts(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Of 64 parts of the remainders above an eighth of a window, how many to cut into grains."""
    large = lengths * SHARES > capacity
    whole, cut = np.zeros(capacity + 1), np.zeros(capacity + 1)
    whole[lengths] = counts
    for length, count in zip(lengths[large].tolist(), counts[large].tolist()):
        np.add.at(cut, grains(length), count)
    windows = float((lengths * counts).sum()) / capacity
    at = np.arange(capacity + 1)
    # A trial of differencing, over rows at even ranks of the counted lengths.
    ranks = (np.random.default_rng(0).permutation(TRIAL) + 0.5) / TRIAL * counts.sum()
    trial = lengths[np.searchsorted(np.cumsum(counts), ranks)] if len(lengths) else lengths
    for parts in range(LEAST_CUT, PARTS_OF, 4):
        left = whole * np.where(at * SHARES > capacity, 1 - parts / PARTS_OF, 1) + cut * parts / PARTS_OF
        if all(left[at * (k + 1) > capacity].sum() <= SLACK * k * windows for k in range(1, SHARES)):
            shares = np.where(trial * SHARES > capacity, parts, LEAST_CUT) * TRIAL // PARTS_OF
            pieces = [p for i, n in enumerate(trial.tolist()) for p in (grains(n) if i < shares[i] else [n])]
            pieces = np.sort(np.array(pieces, np.int64))[::-1]
            ways = int(np.ceil(pieces.sum() / capacity / (1 - PADDING)))
            if not len(pieces) or np.bincount(differencing(pieces, ways), pieces).max() <= capacity:
                return parts
    return PARTS_OF


def pieces_of(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of whole windows and uncut remainders, and ``grains``: checksums of what a remainder may be cut into."""
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = docs.sparkSession.sparkContext.broadcast(file.read())
    key, end = hash((id(tokenizer), tokenizer_path)), np.array([end_id], "<u4").tobytes()
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker(key, tokenizer.value)
        for batch in batches:
            row, start, length, whole, tokens, parts, ends = [], [], [], [], [], [], [0]
            encoded = (ids for first, last in slices(batch.column(1)) for ids in encoder.encode(batch.column(1).slice(first, last - first).fill_null("").to_pylist()))
            for at, ids in enumerate(encoded):
                ids = memoryview(ids + end)
                for begin in range(0, len(ids), 4 * capacity):
                    piece = ids[begin:begin + 4 * capacity]
                    n = len(piece) // 4
                    row.append(at)
                    start.append(begin // 4)
                    length.append(n)
                    whole.append(crc32(piece))
                    tokens.append(len(ids) // 4)
                    if n < capacity:
                        edges = [4 * (n - (n >> i)) for i in range(n.bit_length() + 1)]
                        parts += [crc32(piece[a:b]) for a, b in zip(edges, edges[1:])]
                    ends.append(len(parts))
            columns = [pa.array(c, pa.int64()) for c in (start, length, whole, tokens)]
            cut = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(parts, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *columns, cut],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "grains"])

    return docs.select(id_column, text_column).mapInArrow(
        run, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, grains array<long>")


def differencing(lengths: np.ndarray, ways: int) -> np.ndarray:
    """The window of each piece, by Karmarkar-Karp differencing over ``ways`` windows.

    A partial partition has ``ways`` windows in falling order of their sums, less the
    smallest sum; empty ones have no node. Merged windows form a forest whose leaves
    are pieces, so that no list of pieces is copied.
    """
    n = len(lengths)
    heap = [(-int(length), i) for i, length in enumerate(lengths.tolist())]
    heapq.heapify(heap)
    partial: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    merges, nodes, name = [], n, n

    def take() -> tuple[np.ndarray, np.ndarray]:
        difference, which = heapq.heappop(heap)
        if which in partial:
            return partial.pop(which)
        sums, heads = np.zeros(ways, np.int64), np.full(ways, -1, np.int64)
        sums[0], heads[0] = -difference, which
        return sums, heads

    while len(heap) > 1:
        (sums, heads), (other, tails) = take(), take()
        sums, tails = sums + other[::-1], tails[::-1]
        both = np.flatnonzero((heads >= 0) & (tails >= 0))
        joined = np.maximum(heads, tails)
        if len(both):
            merges.append((nodes, heads[both], tails[both]))
            joined[both] = np.arange(nodes, nodes + len(both))
            nodes += len(both)
        order = np.argsort(-sums, kind="stable")
        sums = sums[order] - sums[order[-1]]
        partial[name] = sums, joined[order]
        heapq.heappush(heap, (-int(sums[0]), name))
        name += 1
    window = np.full(nodes, -1, np.int64)
    _, heads = take()
    window[heads[heads >= 0]] = np.flatnonzero(heads >= 0)
    for first, left, right in reversed(merges):
        window[left] = window[right] = window[first:first + len(left)]
    return window[:n]


def divide(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """A window for each piece, none above ``capacity``, in as few windows as differencing finds."""
    run = np.arange(len(lengths))
    if len(lengths) > 2 * GROUP_PIECES:  # tiny pieces go together
        unit = max(1, capacity // 64)
        tiny = lengths < unit
        together = (np.cumsum(np.where(tiny, lengths, 0)) - np.where(tiny, lengths, 0)) // unit
        _, run = np.unique(np.where(tiny, -1 - together, run), return_inverse=True)
    joined = np.bincount(run, lengths).astype(np.int64)

    def tried(ways: int) -> np.ndarray | None:
        window = differencing(joined, ways)
        return window if np.bincount(window, joined).max() <= capacity else None

    ways, step = fewest(joined, np.ones(len(joined), np.int64), capacity), 1
    failed, found = ways - 1, tried(ways)
    while found is None:
        failed, ways, step = ways, ways + step, 2 * step
        found = tried(ways)
    while ways - failed > 1:
        middle = (ways + failed) // 2
        fewer = tried(middle)
        failed, ways, found = (middle, ways, found) if fewer is None else (failed, middle, fewer)
    return found[run]


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 4096, **columns: str) -> DataFrame:
    """Every piece with its ``sequence_id`` and its ``offset`` there."""
    pieces = stored(pieces_of(docs, tokenizer_path, end_id, capacity, **columns), "pieces")
    parts = pieces.filter(F.col("length") < capacity)
    counted = np.array(parts.groupBy("length").count().collect(), np.int64).reshape(-1, 2)  # fewer than capacity rows
    share = cut_parts(*counted.T, capacity)
    # By the row of a stored table and not by content; repeated rows are dealt out too.
    parts = parts.withColumn("row", F.monotonically_increasing_id())
    of = F.when(F.col("length") * SHARES > capacity, share).otherwise(LEAST_CUT)
    cut = F.expr("""transform(grains, (ids_crc32, i) -> struct(
        start + length - shiftright(length, i) as start, shiftright(length, i) - shiftright(length, i + 1) as length, ids_crc32 as ids_crc32))""")
    uncut = F.array(F.struct("start", "length", "ids_crc32"))
    parts = parts.withColumn("piece", F.explode(F.when(F.pmod(F.xxhash64("row", F.lit(PARTS_OF)), F.lit(PARTS_OF)) < of, cut).otherwise(uncut)))
    mixed = F.xxhash64("row", "piece.start")
    parts = parts.select("doc_id", "piece.start", "piece.length", "piece.ids_crc32", "doc_tokens", mixed.alias("mixed"))
    n_pieces = sum(n * ((PARTS_OF - p) + p * len(grains(length))) // PARTS_OF
                   for length, n in counted.tolist() for p in [share if length * SHARES > capacity else LEAST_CUT])
    n_groups = max(1, min(-(-n_pieces // GROUP_PIECES), int(counted.prod(axis=1).sum()) // (GROUP_WINDOWS * capacity)))
    # Negative numbers for sequences of one whole window, numbers from 0 for the others.
    whole = pieces.filter(F.col("length") == capacity).drop("grains").withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    stride = 1 << 24

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
        lengths = group.length.to_numpy()
        window = divide(lengths, capacity)
        group["sequence_id"] = group.pop("bucket") * stride + window
        group["offset"] = group.groupby("sequence_id").length.cumsum() - group.length
        return group

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in whole.schema)
    mixed_up = parts.withColumn("bucket", F.pmod("mixed", F.lit(n_groups))).drop("mixed")
    return whole.unionByName(mixed_up.groupBy("bucket").applyInPandas(run, schema))
