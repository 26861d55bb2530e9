"""Document fingerprints: minimum hashes of the phrases of a Lempel-Ziv parse.

A text is parsed as LZ78 does: each phrase is the longest earlier phrase that
matches, and one more byte. The set of phrases says how a compressor sees the text;
the share of equal minimum hashes of two sets estimates their likeness.

Documents are dealt out by ranges of falling id, so that a document and the next one
meet in one task; only the edges of tasks are joined again, a row for each task. A
parse of an edited text starts where the edit starts, from the state of the parse of
the unedited text.

Edge cases: a null or empty text has no phrases, and two texts without phrases have
likeness 1; a text of any length is parsed whole, in time that grows with its length;
rows of one id follow each other by a hash of the text; rows with a null
id come last; a single row is its own next; an empty table gives no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from wayprint.llm.scratch import stored
from wayprint.llm.text import span_hashes

N_HASHES = 128  # components of a fingerprint, a byte each
_random = np.random.default_rng(7)
FACTORS = _random.integers(0, 1 << 32, N_HASHES, dtype=np.uint32) | np.uint32(1)
MASKS = _random.integers(0, 1 << 32, N_HASHES, dtype=np.uint32)
NOTHING = np.full(N_HASHES, 0xFFFFFFFF, np.uint32)
ROWS = 4096  # phrases hashed at once


def parse(data: bytes, start: int, phrases: dict[int, int], node: int, ends: list[int]) -> int:
    """Goes on with an LZ78 parse at ``start``: adds phrases (numbered in steps of 256) and their ends; gives the open phrase."""
    find, fresh = phrases.get, 256 * (len(phrases) + 1)
    for at, byte in enumerate(memoryview(data)[start:], start + 1):
        on = find(node + byte)
        if on is None:
            phrases[node + byte] = fresh
            fresh += 256
            ends.append(at)
            node = 0
        else:
            node = on
    return node


def minimums(data: bytes, first: int, ends: list[int]) -> np.ndarray:
    """Minimum hashes of the phrases that end at ``ends``, the first of which begins at ``first``."""
    if not ends:
        return NOTHING
    bounds = np.array([first, *ends]) - first
    hashes = (span_hashes(np.frombuffer(data, np.uint8)[first:ends[-1]], bounds[:-1], bounds[1:]) >> np.uint64(32)).astype(np.uint32)
    found = NOTHING
    for at in range(0, len(hashes), ROWS):
        found = np.minimum(found, ((hashes[at:at + ROWS, None] ^ MASKS) * FACTORS).min(axis=0))
    return found


def printed(mins: np.ndarray) -> bytes:
    return (mins & np.uint32(0xFF)).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The share of equal components, less those that are equal by chance."""
    share = np.count_nonzero(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)) / N_HASHES
    return max(0.0, (share - 1 / 256) / (1 - 1 / 256))


class Parsed:
    """A text with its fingerprint, ready for an edit of its last third."""

    def __init__(self, text: str):
        self.text, self.n_chars = text, len(text)
        self.head = text[:len(text) - len(text) // 3].encode()
        data = text.encode()
        self.phrases, ends = {}, []
        self.node = parse(self.head, 0, self.phrases, 0, ends)
        self.n_phrases, self.cut = len(ends), ends[-1] if ends else 0
        self.mins = minimums(data, 0, ends)
        tail: list[int] = []
        parse(data, len(self.head), self.phrases, self.node, tail)
        self.fingerprint = printed(np.minimum(self.mins, minimums(data, self.cut, tail)))

    def edited(self, following: str) -> tuple[str, bytes]:
        """SHA-256 and fingerprint of the text with its last third from the start of ``following``."""
        data = self.head + following[:self.n_chars // 3].encode()
        while len(self.phrases) > self.n_phrases:
            self.phrases.popitem()
        ends: list[int] = []
        parse(data, len(self.head), self.phrases, self.node, ends)
        self.phrases = {}
        return hashlib.sha256(data).hexdigest(), printed(np.minimum(self.mins, minimums(data, self.cut, ends)))


NUMBERS = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
EDGES = "task int, first_text string, last_text string"


def _row(doc_id: pa.Scalar, text: Parsed, following: str, next_print: bytes) -> tuple:
    sha, edited = text.edited(following)
    return (doc_id.as_py(), text.n_chars, sha, text.fingerprint, edited, likeness(text.fingerprint, edited), likeness(text.fingerprint, next_print))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {id_type}, {NUMBERS}"
    texts = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    order = [F.desc("doc_id"), F.xxhash64("text")]
    both = f"{schema}, {EDGES}"
    types, own = _arrow(both), _arrow(schema)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rows but the last of the task, and a row with the task's first and last text."""
        task, before, first = TaskContext.get().partitionId(), None, None
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                now = Parsed(text.as_py())
                if before is None:
                    first = now.text
                else:
                    rows.append((*_row(*before, now.text, now.fingerprint), None, None, None))
                before = doc_id, now
            if rows:
                yield _batch(rows, types)
        if before is not None:
            yield _batch([(before[0].as_py(), None, None, None, None, None, None, task, first, before[1].text)], types)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last row of each task with the first text of the next one."""
        for batch in batches:
            rows = []
            for doc_id, text, following in zip(*batch.columns):
                rows.append(_row(doc_id, Parsed(text.as_py()), following.as_py(), Parsed(following.as_py()).fingerprint))
            if rows:
                yield _batch(rows, own)

    found = stored(texts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(inside, both), "fingerprints")
    edges = found.filter(F.col("task").isNotNull())
    # Only task numbers, one for each task, meet in this window.
    everywhere = Window.orderBy("task")
    following = edges.select("task").withColumn("next_task", F.coalesce(
        F.lead("task").over(everywhere), F.first("task").over(everywhere)))
    firsts = edges.select(F.col("task").alias("next_task"), "first_text")
    pairs = edges.select("task", "doc_id", "last_text").join(following, "task").join(firsts, "next_task")
    last = pairs.select("doc_id", "last_text", "first_text").mapInArrow(across, schema)
    rows = found.filter(F.col("task").isNull()).select(last.columns).unionByName(last)
    return rows.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _batch(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), types)], schema=types)
