"""SentencePiece BPE: encoding by vectorised merge rounds, and decoding.

A text is normalised as its model says (a mark before it, marks for spaces) and cut
into words; words that a worker has not seen are merged together. Their symbols lie
in flat numpy arrays. In every round each word takes its least pair rank by a segmented
minimum and merges pairs of that rank from the left, all words at once; the arrays
are then compacted, until no pair remains. Characters outside the vocabulary become
byte pieces.

The order is that of one merge at a time: best score first, and of equal scores the
leftmost. Within a round a word therefore merges up to and with the first pair whose
result could make a pair of the same or a better rank. A long word whose rounds merge
little (a run of spaces, whose pieces all score alike) is finished from a queue in the
same order, so that its time grows with its length.

Words end where no piece can go on: before a mark that follows another character,
and at any two neighbouring characters that no piece holds side by side.

Edge cases: a null or empty text is the end id alone and decodes to nothing; texts of
any length are encoded whole; any code point is encodable; equal scores are decided by
place; repeated rows give repeated results; an empty table gives no rows; other columns
of the input are ignored.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from wayprint.llm.text import slices

MARK = "▁"
# Fixed values of the public model format: kinds of pieces, and the kind of model.
NORMAL, UNKNOWN, CONTROL, BYTE, BPE = 1, 2, 3, 6, 2
NO_RANK = np.int64(2**62)
CACHE_SIZE = 400_000  # words whose ids a worker keeps, whatever the input
LONG_WORD, FEW_MERGES = 4096, 64  # symbols of a long word; it leaves the rounds below one merge in so many symbols


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte, at = data[at], at + 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, data[at:at + size]
            at += size


def read_model(path: str) -> dict:
    """Pieces as ``(text, score, kind)`` and the settings that encoding needs, from a ``.model`` file."""
    pieces, trainer, normalizer = [], {}, {}
    with open(path, "rb") as file:
        for field, value in _fields(file.read()):
            if field == 1:
                found = dict(_fields(value))
                pieces.append((found[1].decode(), struct.unpack("<f", found.get(2, b"\0\0\0\0"))[0], found.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
    other = {kind for *_, kind in pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}
    if trainer.get(3, 1) != BPE or not trainer.get(35) or trainer.get(24) or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or other:
        raise ValueError("only BPE models with byte pieces, without a character map, trimmed spaces or user-defined pieces")
    return {"pieces": pieces, "end": trainer.get(42, 2), "prefix": bool(normalizer.get(3, 1)), "unknown": trainer.get(44, b" \xe2\x81\x87 ")}


class Encoder:
    """Encodes texts of one model; keeps the ids of a bounded number of words."""

    def __init__(self, model: dict):
        pieces, self.end, self.prefix = model["pieces"], model["end"], MARK if model["prefix"] else ""
        normal = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.size = len(pieces)
        self.alone = alone = sorted({c for text in normal for c in text} - normal.keys())  # characters that only occur inside pieces
        ids = normal | {c: self.size + i for i, c in enumerate(alone)}
        self.rare = self.size + len(alone)  # from here on: this plus the code point
        self.symbol = self.rare + np.arange(0x110000)
        for text, i in ids.items():
            if len(text) == 1:
                self.symbol[ord(text)] = i
        scores = sorted({pieces[i][1] for i in normal.values()}, reverse=True)
        order = {score: rank for rank, score in enumerate(scores)}
        self.rank_of = np.full(self.size, NO_RANK)
        for i in normal.values():
            self.rank_of[i] = order[pieces[i][1]]
        found = sorted({(ids[text[:cut]] << 32 | ids[text[cut:]], i) for text, i in normal.items()
                        for cut in range(1, len(text)) if text[:cut] in ids and text[cut:] in ids})
        self.keys, self.merged = np.array([k for k, _ in found], np.int64), np.array([i for _, i in found], np.int64)
        beside = sorted({ord(a) << 32 | ord(b) for text in normal for a, b in zip(text, text[1:])})
        self.beside = np.array(beside, np.int64)
        marked = any(a != MARK and b == MARK for text in normal for a, b in zip(text, text[1:]))
        self.words = re.compile("(?s).+" if marked else f"{MARK}*[^{MARK}]+|{MARK}+").findall
        byte_ids = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == BYTE}
        self.byte_ids = [byte_ids[f"<0x{b:02X}>"] for b in range(256)]
        self.known: dict[str, bytes] = {}

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged piece and its rank for each pair; NO_RANK where the pair never merges."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        piece = np.where(self.keys[at] == keys, self.merged[at], -1)
        return piece, np.where(piece >= 0, self.rank_of[piece], NO_RANK)

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of words, as little-endian 32-bit numbers."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        first = np.zeros(len(points) + 1, bool)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        first[starts] = True
        if len(self.beside):
            pair = points[:-1] << 32 | points[1:]
            at = np.minimum(np.searchsorted(self.beside, pair), len(self.beside) - 1)
            first[1:-1] |= self.beside[at] != pair
        segment = np.cumsum(first[:-1]) - 1
        symbols, segment = self._rounds(self.symbol[points], segment)
        counts = np.bincount(segment, minlength=int(first[:-1].sum()))
        upto = np.concatenate([[0], np.cumsum(counts)])
        segment_of_word = np.concatenate([np.cumsum(first[:-1])[starts] - 1, [len(counts)]])
        data, cut = symbols.astype("<u4").tobytes(), upto[segment_of_word].tolist()
        plain = np.concatenate([[0], np.cumsum(symbols >= self.size)])[cut]
        return [data[4 * a:4 * b] if plain[w] == plain[w + 1] else self._with_bytes(symbols[a:b])
                for w, (a, b) in enumerate(zip(cut, cut[1:]))]

    def _with_bytes(self, symbols: np.ndarray) -> bytes:
        out = []
        for s in symbols.tolist():
            if s < self.size:
                out.append(s)
            else:
                out += [self.byte_ids[b] for b in (self.alone[s - self.size] if s < self.rare else chr(s - self.rare)).encode()]
        return np.array(out, "<u4").tobytes()

    def _rounds(self, symbols: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols of all segments, in order; a segment's pairs never reach into another."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        piece = rank = None
        while len(symbols):
            if piece is None:
                piece, rank = np.full(len(symbols), -1), np.full(len(symbols), NO_RANK)
                inner = np.flatnonzero(segment[:-1] == segment[1:])
                piece[inner], rank[inner] = self._pairs(symbols[inner], symbols[inner + 1])
            starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            sizes = np.diff(np.append(starts, len(symbols)))
            least = np.minimum.reduceat(rank, starts)
            over = least == NO_RANK
            if over.any():
                gone = np.repeat(over, sizes)
                done.append((symbols[gone], segment[gone]))
                symbols, segment, piece, rank = (x[~gone] for x in (symbols, segment, piece, rank))
                starts, sizes, least = np.cumsum(sizes[~over]) - sizes[~over], sizes[~over], least[~over]
                if not len(symbols):
                    break
            local = np.repeat(least, sizes)
            at = np.flatnonzero(rank == local)
            # Of neighbouring pairs every second one, counted from the left end of their run.
            fresh = np.concatenate([[True], np.diff(at) != 1])
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            made, bound = piece[at], local[at]
            new = symbols.copy()
            new[at] = made
            taken = np.zeros(len(symbols) + 1, bool)
            taken[at + 1] = True
            # Neighbours at the moment of the merge: what stands left is merged already, what stands right is not.
            before = at - 1 - taken[at - 1]
            has = (at > 0) & (segment[np.maximum(at - 1, 0)] == segment[at])
            risky = np.zeros(len(at), bool)
            risky[has] = self._pairs(new[before[has]], made[has])[1] <= bound[has]
            after = np.minimum(at + 2, len(symbols) - 1)
            has = (at + 2 < len(symbols)) & (segment[after] == segment[at])
            risky[has] |= self._pairs(made[has], symbols[after[has]])[1] <= bound[has]
            if risky.any():
                limit = np.full(int(segment[-1]) + 1, len(symbols))
                np.minimum.at(limit, segment[at[risky]], at[risky])
                at = at[at <= limit[segment[at]]]
            slow = sizes > LONG_WORD
            if slow.any():
                slow &= np.bincount(np.searchsorted(starts, at, side="right") - 1, minlength=len(starts)) * FEW_MERGES < sizes
                for s in np.flatnonzero(slow).tolist():
                    part = slice(int(starts[s]), int(starts[s] + sizes[s]))
                    done.append((found := self._queue(symbols[part]), np.full(len(found), segment[part.start])))
                out = np.repeat(slow, sizes)
                if out.any():
                    shift = np.cumsum(out)
                    at = at[~out[at]]
                    at = at - shift[at]
                    symbols, segment, piece, rank = (x[~out] for x in (symbols, segment, piece, rank))
            symbols = symbols.copy()
            symbols[at] = piece[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            symbols, segment, piece, rank = (x[keep] for x in (symbols, segment, piece, rank))
            if not len(symbols):
                break
            beside = np.zeros(len(symbols), bool)
            beside[at] = beside[np.maximum(at - 1, 0)] = True
            changed = np.flatnonzero(beside)
            changed_inner = changed[changed + 1 < len(symbols)]
            changed_inner = changed_inner[segment[changed_inner] == segment[changed_inner + 1]]
            piece[changed], rank[changed] = -1, NO_RANK
            piece[changed_inner], rank[changed_inner] = self._pairs(symbols[changed_inner], symbols[changed_inner + 1])
        if not done:
            return symbols, segment
        symbols, segment = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(segment, kind="stable")
        return symbols[order], segment[order]

    def _queue(self, symbols: np.ndarray) -> np.ndarray:
        """One long word, merged pair by pair in the order of rank and place."""
        piece, rank = (x.tolist() for x in self._pairs(symbols[:-1], symbols[1:]))
        found, n = symbols.tolist(), len(symbols)
        follow, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i, p) for i, (r, p) in enumerate(zip(rank, piece)) if p >= 0]
        heapq.heapify(queue)
        current = {i: p for _, i, p in queue}

        def offer(i: int) -> None:
            current.pop(i, None)
            if i >= 0 and follow[i] < n:
                key = found[i] << 32 | found[follow[i]]
                at = int(np.searchsorted(self.keys, key))
                if at < len(self.keys) and self.keys[at] == key:
                    current[i] = int(self.merged[at])
                    heapq.heappush(queue, (int(self.rank_of[current[i]]), i, current[i]))

        while queue:
            _, i, p = heapq.heappop(queue)
            if current.get(i) != p:
                continue
            gone = follow[i]
            found[i], found[gone], follow[i] = p, -1, follow[gone]
            current.pop(gone, None)
            if follow[i] < n:
                before[follow[i]] = i
            offer(before[i])
            offer(i)
        return np.array([s for s in found if s >= 0], np.int64)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts with the end id, as little-endian 32-bit numbers."""
        cut = [self.words(self.prefix + text.replace(" ", MARK)) if text else [] for text in texts]
        fresh = set().union(*cut) - self.known.keys()
        if len(self.known) + len(fresh) > CACHE_SIZE:
            self.known = {}
            fresh = set().union(*cut)
        if fresh:
            fresh = list(fresh)
            self.known.update(zip(fresh, self.merge(fresh)))
        find, end = self.known.__getitem__, self.end.to_bytes(4, "little")
        return [b"".join(map(find, words)) + end for words in cut]


def _one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("wayprint.one_byte", _one_byte)


class Decoder:
    """Texts of ids: marks become spaces, byte pieces bytes, control pieces nothing."""

    def __init__(self, model: dict):
        kinds = {UNKNOWN: lambda text: model["unknown"], CONTROL: lambda text: b"", BYTE: lambda text: bytes([int(text[3:5], 16)]),
                 NORMAL: lambda text: text.replace(MARK, " ").encode()}
        pieces = [kinds[kind](text) for text, _, kind in model["pieces"]]
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts, self.data = np.cumsum(self.lengths) - self.lengths, np.frombuffer(b"".join(pieces), np.uint8)
        self.marked = np.array([model["prefix"] and kind == NORMAL and text.startswith(MARK) for text, _, kind in model["pieces"]])

    def decode(self, ids: bytes) -> str:
        found = np.frombuffer(ids, "<u4")
        sizes = self.lengths[found]
        silent = np.flatnonzero(sizes == 0)  # control pieces; bytes on either side do not belong together
        spoken = found[sizes > 0]
        text = "".join(map(self._text, np.split(found, silent))) if len(silent) else self._text(found)
        return text[1:] if len(spoken) and self.marked[spoken[0]] else text

    def _text(self, found: np.ndarray) -> str:
        sizes = self.lengths[found]
        at = np.repeat(self.starts[found] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return self.data[at].tobytes().decode("utf-8", "wayprint.one_byte")


_workers: dict[int, tuple] = {}


def _worker(key: int, model: Broadcast) -> tuple[Encoder, Decoder]:
    """Encoder and decoder of this worker process, kept from task to task."""
    if key not in _workers:
        _workers.clear()
        _workers[key] = Encoder(model.value), Decoder(model.value)
    return _workers[key]


def encode_texts(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: ids with the end id, and the text they decode to.

    ``model_path`` is read by the driver alone; its bounded content is broadcast.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    key = hash((id(model), model_path))
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _worker(key, model)
        for batch in batches:
            for start, end in slices(batch.column(1)):
                ids = encoder.encode([text or "" for text in batch.column(1).slice(start, end - start).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype(np.int32)
                numbers = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.ListArray.from_arrays(pa.array(offsets), numbers),
                     pa.array(map(decoder.decode, ids), pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select(id_column, text_column).mapInArrow(run, f"doc_id {id_type}, ids array<int>, decoded string")


def digest_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text."""
    return encode_texts(docs, model_path).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
