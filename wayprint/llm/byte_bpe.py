"""Byte-level BPE: encoding by padded matrices of pieces, and decoding.

A text is cut by the tokenizer's pattern into pieces, and each piece is merged
alone. Pieces of like length share one numpy matrix of token ids, a row each; in
every round each row merges its leftmost pair of least rank. Ranks of pairs are
found in a hashed table; merged rows are compacted to the left.

A long piece is first cut between bytes that are neighbours in no token, which no merge
can cross. What is still long is a row of its own, which in a round merges its least pair
wherever it occurs, from the left, unless the merged token takes part in a pair of lower
rank. The order of merges is the same, in as many rounds as different tokens arise.

Edge cases: a null or empty text has no ids and decodes to nothing; any code point
is encodable as bytes; a text of any length is encoded whole; of pairs with equal rank the
leftmost merges first; repeated rows give repeated results; an empty table gives
no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

NO_PAIR = np.int32(2**31 - 1)
CACHE_SIZE = 600_000  # pieces whose ids a worker keeps, whatever the input
MATRIX_CELLS = 1 << 20
LONG = 256  # bytes beyond which a piece is cut, or a row of its own


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class PairTable:
    """Open-addressing hash table from a pair of ids to the id of the merged token."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        # Whether every pair that a token takes part in has a higher rank than the token.
        self.rising = np.full(max(ranks.values()) + 1, NO_PAIR)
        np.minimum.at(self.rising, left + right, np.array(merged + merged, np.int32))
        self.rising = self.rising > np.arange(len(self.rising))
        self.inside = np.zeros((256, 256), bool)  # bytes that are neighbours in a token
        for token in ranks:
            for a, b in zip(token, token[1:]):
                self.inside[a, b] = True
        keys = np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64)
        self.bits = max(4, int(2.5 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.full(1 << self.bits, NO_PAIR)
        slots, todo, values = self._slot(keys), np.arange(len(keys)), np.array(merged, np.int32)
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = todo[self.values[slots[todo]] == NO_PAIR]
            _, firsts = np.unique(slots[free], return_index=True)
            placed = free[firsts]
            self.keys[slots[placed]], self.values[slots[placed]] = keys[placed], values[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            slots[todo] = (slots[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id (its rank) of each pair; NO_PAIR where the pair never merges."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slots, out = self._slot(keys), np.full(len(keys), NO_PAIR)
        rest = np.arange(len(keys))
        for _ in range(self.probes):
            stored = self.keys[slots]
            hit = stored == keys[rest]
            out[rest[hit]] = self.values[slots[hit]]
            on = ~hit & (self.values[slots] != NO_PAIR)
            if not on.any():
                break
            rest, slots = rest[on], (slots[on] + 1) & ((1 << self.bits) - 1)
        return out


class Encoder:
    """Encodes texts of one vocabulary; keeps the ids of a bounded number of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.cut = ranks, regex.compile(pattern).findall
        self.pairs, self.known = PairTable(ranks), {}
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces, as little-endian 32-bit numbers."""
        cut = [self._parts(piece) if len(piece) > LONG else [piece] for piece in pieces]
        found = iter(self._bucketed([part for parts in cut for part in parts]))
        return [b"".join(islice(found, len(parts))) for parts in cut]

    def _parts(self, piece: bytes) -> list[bytes]:
        """The piece cut where no merge can cross."""
        data = np.frombuffer(piece, np.uint8)
        edges = [0, *(np.flatnonzero(~self.pairs.inside[data[:-1], data[1:]]) + 1).tolist(), len(piece)]
        return [piece[a:b] for a, b in zip(edges, edges[1:])]

    def _row(self, piece: bytes) -> bytes:
        """Ids of a long piece: each round merges all of its least pair."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)]
        ranks = np.append(self.pairs.find(ids[:-1], ids[1:]), NO_PAIR)
        while (least := ranks.min()) != NO_PAIR:
            at = np.flatnonzero(ranks == least)
            if self.pairs.rising[least]:
                run = np.cumsum(np.diff(at, prepend=-1) > 1)  # of overlapping pairs, every other one merges
                first = np.searchsorted(run, run)
                at = at[(np.arange(len(at)) - first) % 2 == 0]
            else:
                at = at[:1]
            ids[at] = least
            kept = np.ones(len(ids), bool)
            kept[at + 1] = False
            ids, ranks = ids[kept], ranks[kept]
            at -= np.arange(len(at))
            for beside in (at[at > 0] - 1, at):
                ranks[beside] = NO_PAIR
                beside = beside[beside + 1 < len(ids)]
                ranks[beside] = self.pairs.find(ids[beside], ids[beside + 1])
        return ids.astype("<u4").tobytes()

    def _bucketed(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(lengths, kind="stable")
        start = 0
        while start < len(order):  # a matrix of rows of at most 1.25 times the shortest one's length
            if lengths[order[start]] > LONG:
                for row in order[start:].tolist():
                    out[row] = self._row(pieces[row])
                break
            longest = min(max(int(lengths[order[start]] * 1.25), 4), LONG)
            end = min(int(np.searchsorted(lengths[order], longest, side="right")), start + max(1, MATRIX_CELLS // longest))
            rows = order[start:end]
            for row, ids in zip(rows.tolist(), self._matrix([pieces[r] for r in rows.tolist()], lengths[rows])):
                out[row] = ids
            start = end
        return out

    def _matrix(self, pieces: list[bytes], lengths: np.ndarray) -> list[bytes]:
        n, width = len(pieces), int(lengths.max())
        ids = np.full((n, width), -1, np.int32)
        inside = np.arange(width) < lengths[:, None]
        ids[inside] = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.full((n, width), NO_PAIR)  # of the pair that begins in a column
        row, column = np.nonzero(inside[:, 1:])
        ranks[row, column] = self.pairs.find(ids[row, column], ids[row, column + 1])
        done: list[bytes] = [b""] * n
        who, size = np.arange(n), lengths.copy()
        while len(who):
            best = ranks.argmin(axis=1)
            least = ranks[np.arange(len(who)), best]
            over = least == NO_PAIR
            if over.any():
                data, step = ids[over].astype("<u4").tobytes(), 4 * ids.shape[1]
                for k, (piece, bytes_) in enumerate(zip(who[over].tolist(), (4 * size[over]).tolist())):
                    done[piece] = data[k * step:k * step + bytes_]
                on = ~over
                who, size, best, least = who[on], size[on], best[on], least[on]
                if not len(who):
                    break
                ids, ranks = ids[on, :int(size.max())], ranks[on, :int(size.max())]
            r, width = np.arange(len(who)), ids.shape[1]
            ids[r, best] = least
            take = np.arange(width - 1) + (np.arange(width - 1) > best[:, None])  # compaction: one id less in each row
            ids, ranks = np.take_along_axis(ids, take, 1), np.take_along_axis(ranks, take, 1)
            size -= 1
            for at in (best - 1, best):  # the pairs beside the merged id
                ok = (at >= 0) & (at + 1 < size)
                ranks[r[at >= 0], at[at >= 0]] = NO_PAIR
                ranks[r[ok], at[ok]] = self.pairs.find(ids[r[ok], at[ok]], ids[r[ok], at[ok] + 1])
        return done

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, as little-endian 32-bit numbers."""
        cut = [self.cut(text) for text in texts]
        fresh = set().union(*cut) - self.known.keys()
        if len(self.known) + len(fresh) > CACHE_SIZE:
            self.known = {}
            fresh = set().union(*cut)
        whole, split = {}, []
        for piece in fresh:
            rank = self.ranks.get(piece.encode())
            if rank is None:
                split.append(piece)
            else:
                whole[piece] = rank.to_bytes(4, "little")
        self.known |= whole
        self.known.update(zip(split, self.merge([piece.encode() for piece in split])))
        find = self.known.__getitem__
        return [b"".join(map(find, pieces)) for pieces in cut]


class Decoder:
    """Bytes of ids."""

    def __init__(self, ranks: dict[bytes, int]):
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        self.starts, self.lengths = np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths
        self.data = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)

    def decode(self, ids: bytes) -> bytes:
        found = np.frombuffer(ids, "<u4")
        sizes = self.lengths[found]
        at = np.repeat(self.starts[found] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return self.data[at].tobytes()


_workers: dict[int, tuple] = {}


def _worker(key: int, ranks: Broadcast, pattern: str) -> tuple[Encoder, Decoder]:
    """Encoder and decoder of this worker process, kept from task to task."""
    if key not in _workers:
        _workers.clear()
        _workers[key] = Encoder(ranks.value, pattern), Decoder(ranks.value)
    return _workers[key]


def _groups(texts: list[str | None], most: int = 1 << 20) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size > most:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: ids as little-endian 32-bit numbers, and the bytes they decode to.

    ``ranks_path`` is read by the driver alone; its bounded content is broadcast.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    key = hash((id(ranks), ranks_path, pattern))
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _worker(key, ranks, pattern)
        for batch in batches:
            at = 0
            for group in _groups(batch.column(1).to_pylist()):
                ids = encoder.encode(group)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(group)), pa.array(ids, pa.binary()), pa.array(map(decoder.decode, ids), pa.binary())],
                    names=["doc_id", "ids", "decoded"])
                at += len(group)

    return docs.select(id_column, text_column).mapInArrow(run, f"doc_id {id_type}, ids binary, decoded binary")


def digest_texts(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text."""
    return encode_texts(docs, ranks_path, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
