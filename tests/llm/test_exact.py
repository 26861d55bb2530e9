"""Tokenizing, packing, deduplication and the pipeline against brute force and the tokenizers' own libraries."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF_TINY
from tests.llm import brute
from tests.llm.conftest import EDGES
from wayprint.llm import byte_bpe, near_dedup, packing, queries, suffix_dedup, text

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def hostile_texts():
    rng = random.Random(1)
    points = [32, 10, 9, 39, 115, 65, 0x300, 0x41F, 0x661, 0x2028, 0x1F600, 49, 0xA0, 0x85, 0x1C, 0xDF, 0x130, 0x3A3]
    return ["".join(chr(rng.choice(points)) for _ in range(400)) for _ in range(30)] + ["", "a" * 3000, "<|endoftext|> x", "don't we'RE", "Éa ß÷×"]


def test_bpe_equals_the_library(spark):
    ranks = byte_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, decoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN), byte_bpe.Decoder(ranks)
    for text, ids in zip(hostile_texts(), encoder.encode(hostile_texts())):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert decoder.decode(ids) == text.encode()
    texts = brute.documents(SF_TINY)
    for row in queries.op5_byte_bpe(spark, SF_TINY).collect():
        ids = np.array(library.encode_ordinary(texts[row.doc_id]), "<u4")
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), brute.sha(ids.tobytes()), brute.sha(texts[row.doc_id]))


def test_bpe_of_long_pieces():
    ranks, rng = byte_bpe.read_ranks(RANKS), random.Random(3)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    words = brute.documents(SF_TINY)[1].split()
    texts = ["".join(rng.choices(letters, k=n)) for n in (257, 1000, 20_000) for letters in ("a", "ab", "etaoinshr", "abcdefghijklmnopqrstuvwxyz", "дежик", "日本語", "=-")]
    for text in [*texts, "".join(w for w in words if w.isalpha()), "".join(rng.choices("etaoinshrdlucm", k=200_000))]:
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)
    # A token that is a part of one with a lower rank merges one pair a round.
    odd = {bytes([b]): b for b in range(256)} | {b"aba": 256, b"ab": 257, b"ba": 258, b"abab": 259}
    text = "".join(rng.choices("abc", k=2000))
    plain = tiktoken.Encoding("odd", pat_str=r"\w+", mergeable_ranks=odd, special_tokens={}).encode_ordinary(text)
    assert np.frombuffer(byte_bpe.Encoder(odd, r"\w+").encode([text])[0], "<u4").tolist() == plain


def test_bpe_on_edge_cases(edges, nothing):
    rows = byte_bpe.encode_texts(edges, RANKS, public_tokenizers.PATTERN).collect()
    assert collections.Counter((r.doc_id, bytes(r.decoded)) for r in rows) == collections.Counter((d, (t or "").encode()) for d, t in EDGES)
    assert byte_bpe.digest_texts(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def packs(rows, texts, capacity):
    """Checks pieces against the tokenizer; gives the share of padding."""
    tokenizer = Tokenizer.from_file(WORDS)
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for d, text in texts.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(pieces.pop(d), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert not pieces
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return 1 - sum(r.length for r in rows) / (capacity * len(sequences))


def test_packing(spark):
    assert packs(queries.op2_packing(spark, SF_TINY).collect(), brute.documents(SF_TINY), 4096) < 0.05


def test_packing_on_edge_cases(spark, edges, nothing):
    unique = edges.dropDuplicates(["doc_id", "text"]).filter("doc_id is not null")
    packs(packing.pack(unique, WORDS, 2, 64).collect(), {d: t or "" for d, t in EDGES if d is not None}, 64)
    assert packing.pack(nothing, WORDS, 2, 64).count() == 0


def test_word_ids_equal_the_tokenizer():
    tokenizer, encoder = Tokenizer.from_file(WORDS), packing.WordEncoder(open(WORDS, encoding="utf-8").read())
    for text, ids in zip(hostile_texts(), encoder.encode(hostile_texts())):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(4))
def test_differencing(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.integers(1, 4096, 200))[::-1]
    window = packing.divide(lengths, 4096)
    sums = np.bincount(window, lengths)
    assert sums.max() <= 4096 and len(window) == 200
    even = np.bincount(packing.differencing(np.arange(60, 0, -1), 4), np.arange(60, 0, -1), 4)
    assert even.sum() == 1830 and even.max() - even.min() <= 2


def test_repeats_match_brute_force(spark):
    want = brute.without_repeats(brute.documents(SF_TINY), 50)
    rows = queries.op8_suffix_dedup(spark, SF_TINY).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want


@pytest.mark.parametrize("crowd", [0, 5000])
def test_repeats_of_small_texts(spark, monkeypatch, crowd):
    """Short alphabets and periods; also with every anchor divided."""
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    rng = random.Random(crowd)
    texts = {i: "".join(rng.choice("ab") for _ in range(rng.randrange(90))) for i in range(0, 40)}
    texts |= {50: "ab" * 60, 51: "ba" * 70, 52: "x" + "ab" * 30 + "y", 53: texts[3], 54: "é" * 40}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for length in (8, 20):
        found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digest_repeats(docs, length).collect()}
        assert found == brute.without_repeats(texts, length)


def test_only_segments_that_share_a_string_are_sorted(monkeypatch):
    rng, sorted_ones = random.Random(8), []
    word = lambda n: bytes(rng.choices(b"abcdefgh", k=n))
    shared, anchor = word(60), word(16)
    strings = [word(34) + anchor + word(34) for _ in range(200)] + [word(9) + shared, shared + word(3), shared[:50], word(30) + shared[:49]]
    ids = np.arange(len(strings))
    assert np.flatnonzero(suffix_dedup.meeting(strings, ids, 50)).tolist() == [200, 201, 202]
    assert not suffix_dedup.meeting(strings, np.zeros(len(strings), np.int64), 50).any()  # one id never meets itself
    for i, least in enumerate(suffix_dedup.first_ids(strings, ids, 50)):
        assert (least < ids[i]).any() == (i in (201, 202))

    plain = suffix_dedup.first_ids
    monkeypatch.setattr(suffix_dedup, "first_ids", lambda strings, *rest: sorted_ones.extend(strings) or plain(strings, *rest))
    table = pa.table({"segment": strings, "least": ids, "uses": ids})
    offsets = suffix_dedup.group_offsets(table, 50)["offsets"].to_pylist()
    assert len(sorted_ones) == 3 and [bool(x) for x in offsets] == [i in (201, 202) for i in range(len(strings))]


def test_anchors_hash_all_windows_at_once(monkeypatch):
    """Neighbouring windows are slices of the running sum; looked up place by place they took twice the time."""
    data = np.frombuffer("né 😀 of a text that repeats, of a text that repeats".encode() * 3, np.uint8)
    for size in (1, 16, len(data)):
        starts = np.arange(len(data) - size + 1)
        assert (text.window_hashes(data, size) == text.span_hashes(data, starts, starts + size)).all()
    monkeypatch.setattr(suffix_dedup, "span_hashes", None)
    owners, begin, n, _ = suffix_dedup.anchors(data, np.array([0, 0, 60, len(data)]), 50)
    for owner, strings in ((1, 11), (2, len(data) - 60 - 49)):
        assert sorted(i for b, k in zip(begin[owners == owner], n[owners == owner]) for i in range(b, b + k)) == list(range(strings))


def test_segments_are_cut_many_at_once(spark, monkeypatch):
    """Texts of a batch are cut together, and in parts where their segments are large."""
    texts = [("né 😀 " + chr(97 + i) * 9) * (5 + i) for i in range(8)]
    marks = [[(at, 1 + at % 7, 10 * i + at) for at in range(0, 30, 3)][:i] for i in range(8)]
    rows = [(i, -i, 100 + i, t, m) for i, (t, m) in enumerate(zip(texts, marks))]
    table = spark.createDataFrame(rows, "k1 long, k2 long, first long, text string, marks array<struct<start int, n int, anchor long>>").coalesce(1)
    want = sorted((i, -i, 100 + i, at, t.encode()[at:at + n + 11], a) for i, _, _, t, m in rows for at, n, a in m)
    for cut in (1, 40, 1 << 20):
        monkeypatch.setattr(suffix_dedup, "CUT", cut)
        found = suffix_dedup.cut_segments(table, 12).collect()
        assert sorted((r.k1, r.k2, r.first, r.start, bytes(r.segment), r.anchor) for r in found) == want


def test_transform_is_that_of_all_suffixes(tmp_path):
    rng = random.Random(2)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))).encode() for _ in range(25)]
    symbols, prefixes = suffix_dedup.sort_collection(strings, str(tmp_path))
    suffixes = sorted((s[at:], i, s[at - 1] + 1 if at else 0) for i, s in enumerate(strings) for at in range(len(s) + 1))
    assert symbols.tolist() == [x[2] for x in suffixes]
    for (a, *_), (b, *_), common in zip(suffixes, suffixes[1:], prefixes[1:].tolist()):
        assert common == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_repeats_on_edge_cases(edges, nothing):
    rows = suffix_dedup.digest_repeats(edges.select("doc_id", "text", "k1", "first", "spans")).collect()
    assert len(rows) == len(EDGES)
    gone = {r.doc_id: r.n_removed for r in rows}
    assert gone[1] == 0 and gone[2] == len(EDGES[0][1]) and gone[3] == gone[6] == 0
    assert {r.n_removed for r in rows if r.doc_id is None and r.n_bytes} == {len(EDGES[0][1])}
    kept = suffix_dedup.without_repeats(edges)
    assert kept.columns == edges.columns and {r.doc_id: r.text for r in kept.collect()}[2] == ""
    assert suffix_dedup.digest_repeats(nothing).count() == suffix_dedup.without_repeats(nothing).count() == 0


def test_near_duplicates_match_brute_force(spark):
    want = brute.near_duplicates(brute.documents(SF_TINY), 4, 80)
    rows = queries.op9_minhash_dedup(spark, SF_TINY).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_a_large_group_of_near_copies(spark):
    """Copies that differ from a base in a few words each, some pairs of which are no links."""
    rng = random.Random(4)
    base, texts = [f"w{i}" for i in range(120)], {}
    for d in range(150):
        words = list(base)
        for at in rng.sample(range(120), rng.randrange(0, 6)):
            words[at] = f"x{rng.random()}"
        texts[d] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = near_dedup.near_duplicates(docs, 4, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.near_duplicates(texts, 4, 80)


def test_near_duplicates_on_edge_cases(edges, nothing):
    rows = near_dedup.near_duplicates(edges).collect()
    assert len(rows) == len(EDGES)
    found = {r.doc_id: r for r in rows}
    assert found[2].component_id == 1 and not found[2].kept
    assert all(found[d].n_shingles == 0 and found[d].kept for d in (3, 4, 5))
    assert found[7].n_shingles == 1 and found[7].kept and found[6].kept
    kept = near_dedup.keep_one(edges)
    assert kept.columns == edges.columns and kept.filter("doc_id = 2").isEmpty() and kept.filter("doc_id = 6").count() == 2
    assert near_dedup.near_duplicates(nothing).count() == near_dedup.keep_one(nothing).count() == 0


def test_pipeline(spark):
    """Each stage on what its predecessor kept, against brute force where there is one."""
    docs = queries.table(spark, SF_TINY, "documents")
    columns = docs.columns
    good = corpus_pipeline.quality(spark, docs, SF_TINY).cache()
    assert good.columns == columns and 0 < good.count() < docs.count()
    lines = corpus_pipeline.lines(spark, good, SF_TINY).cache()
    assert lines.columns == columns and lines.count() == good.count()
    unique = corpus_pipeline.near_duplicates(spark, lines, SF_TINY).cache()
    texts = {r.doc_id: r.text or "" for r in lines.collect()}
    near = brute.near_duplicates(texts, 5, 80)
    assert unique.columns == columns and {r.doc_id for r in unique.collect()} == {d for d, (_, c) in near.items() if c == d}
    cut = corpus_pipeline.repeated_strings(spark, unique, SF_TINY).cache()
    before = {r.doc_id: r.text or "" for r in unique.collect()}
    after = {r.doc_id: r.text or "" for r in cut.collect()}
    wanted = brute.without_repeats(before, 50)
    assert cut.columns == columns and set(after) == set(before)
    assert all(wanted[d][3] == brute.sha(after[d]) for d in after if wanted[d][1] == len(before[d].encode()) - len(after[d].encode()))
    packs(corpus_pipeline.sequences(spark, cut, SF_TINY).collect(), after, 4096)
    assert set(corpus_pipeline.run(spark, SF_TINY).columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "MinHash near-dedup", "suffix-array dedup", "packing"]
