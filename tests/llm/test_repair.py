"""Filter interaction audit, conversation repair and SentencePiece encoding against brute force and the library."""

import collections
import itertools
import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, SF_TINY
from tests.llm import brute
from tests.llm.conftest import EDGES
from wayprint.llm import conversation_repair as cr, filter_audit, piece_bpe, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    model = piece_bpe.read_model(MODEL)
    return piece_bpe.Encoder(model), piece_bpe.Decoder(model)


POINTS = [32, 32, 10, 9, 39, 115, 65, 0x300, 0x41F, 0x661, 0x2028, 0x1F600, 49, 0xA0, 0x2581, 0x3000, 0, 0xFFFD, 0xDF, 97, 101, 116, 104, 110, 22909]


def test_pieces_equal_the_library(library, coder):
    rng = random.Random(3)
    texts = ["".join(chr(rng.choice(POINTS)) for _ in range(rng.randrange(300))) for _ in range(200)]
    texts += ["".join(rng.choice("aabe t ") for _ in range(200)) for _ in range(100)]
    texts += ["", " ", "a" * 3000, " " * 37, " " * 5000 + "x", "ab" * 3000, "<s> </s> <0x0A>", "日本" * 3000]
    encoder, decoder = coder
    for text, ids in zip(texts, encoder.encode(texts)):
        want = library.encode(text) + [library.eos_id()]
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoder.decode(ids) == library.decode(want)


@pytest.mark.parametrize("text", ["a", " ", "=-", "\n"])
def test_pieces_of_a_very_long_word(library, coder, text):
    long = text * (100_000 // len(text))
    assert np.frombuffer(coder[0].encode([long])[0], "<u4").tolist() == library.encode(long) + [2]


def test_decoding_any_ids(library, coder):
    rng = random.Random(5)
    for _ in range(500):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(32000)]) for _ in range(rng.randrange(8))]
        assert coder[1].decode(np.array(ids, "<u4").tobytes()) == library.decode(ids)


def test_piece_query(spark, library):
    texts = brute.documents(SF_TINY)
    rows = queries.op11_piece_bpe(spark, SF_TINY).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id]) + [2]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids)))


def test_pieces_on_edge_cases(edges, nothing, library):
    rows = piece_bpe.encode_texts(edges, MODEL).collect()
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in rows) == collections.Counter((d, (*library.encode(t or ""), 2)) for d, t in EDGES)
    assert piece_bpe.digest_texts(nothing, MODEL).count() == 0


def test_intervals_cover_each_order_once():
    """Every mask is removed once in every order, at the step of the first filter that it fails."""
    changes = collections.Counter()
    for mask, step, rank, sign in filter_audit.intervals("ABCDE"):
        changes[mask, step, rank] += sign
    for mask in range(1, 32):
        for step in range(1, 6):
            here = 0
            for rank, order in enumerate(itertools.permutations("ABCDE")):
                here += changes[mask, step, rank]
                first = next(i for i, f in enumerate(order, 1) if mask >> "ABCDE".index(f) & 1)
                assert here == (first == step)


AUDIT = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def as_audit(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in AUDIT) for r in df.collect()}


def test_audit_matches_brute_force(spark):
    docs, labels = (pd.read_parquet(f"{SF_TINY}/{t}.parquet") for t in ("documents", "labels"))
    fails = brute.failing(brute.documents(SF_TINY))
    good, toxic = (dict(zip(labels.doc_id, labels[c])) for c in ("quality", "toxic"))
    rows = [(s or "", fails[d], int(good.get(d) == 1), int(toxic.get(d) == 1)) for d, s in zip(docs.doc_id, docs.source)]
    found = as_audit(queries.op12_filter_audit(spark, SF_TINY))
    assert found == brute.audit(rows) and len(found) == 600 * docs.source.nunique()


def test_audit_on_edge_cases(spark, edges, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 1), (3, 0, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    docs = edges.withColumn("source", F.when(F.col("doc_id") % 2 == 0, "x")).withColumn("digest", F.lit(1)).withColumn("spread", F.lit(2))
    texts = {d: t or "" for d, t in EDGES if d is not None}
    fails = {**brute.failing(texts)}
    rows = [("x" if d is not None and d % 2 == 0 else "", fails[d] if d is not None else brute.failing({0: t or ""})[0],
             int(d == 1), int(d in (1, 3))) for d, t in EDGES]
    assert as_audit(filter_audit.audit_documents(docs, labels)) == brute.audit(rows)
    assert filter_audit.audit_documents(nothing.withColumn("source", F.lit("")), labels).count() == 0


def as_repaired(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def mended(rows):
    grouped = collections.defaultdict(list)
    for r in rows:
        grouped[r[0]].append(r)
    out = {}
    for conv, found in grouped.items():
        *counts, turns = brute.mend(found)
        out[conv] = (*counts, brute.sha("\n".join(f"{r}:{t}" for r, t in turns)))
    return out


@pytest.mark.parametrize("sf", [SF_TINY, SF_SMALL])
def test_repair_matches_brute_force(spark, sf):
    turns = pd.read_parquet(f"{sf}/conversations.parquet")
    rows = [tuple(None if pd.isna(x) else x for x in r) for r in turns[["conv_id", "turn", "role", "text"]].itertuples(index=False)]
    want = {conv: (0, 0, 0, 0, 0, 0, "", brute.sha("")) for conv in {r[0] for r in rows}} | mended(brute.damage(rows))
    assert as_repaired(queries.op13_conversation_repair(spark, sf)) == want


def hostile(n, seed):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "u", "s"], ["Hi.", "no end", "", " ", None, "What?", "é。", "x! \n"]
    return [(rng.randrange(n // 6), rng.choice([None, *range(8)]), rng.choice(roles), rng.choice([*texts, f"text {rng.random()}."])) for _ in range(n)]


def filled(rows):
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], r[3]))


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_repair_of_hostile_rows(spark):
    rows = hostile(900, 1) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes.")]
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as gone", "2 as code", "3 as part", "4 as at")
    assert as_repaired(cr.digests(turns)) == mended(filled(rows))
    repaired = collections.defaultdict(list)
    for r in cr.repair(turns).orderBy("conv_id", "position").collect():
        repaired[r.conv_id].append((r.role, r.text))
    by = collections.defaultdict(list)
    for r in filled(rows):
        by[r[0]].append(r)
    assert {c: t for c, t in repaired.items()} == {c: list(brute.mend(r)[-1]) for c, r in by.items() if brute.mend(r)[-1]}
    assert cr.digests(turns.limit(0)).count() == cr.repair(turns.limit(0)).count() == 0


def test_a_long_conversation_is_solved_in_blocks(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(1, t, rng.choice(["user", "user", "assistant", "system"]), rng.choice([f"text {t}.", f"text {t}", "again."])) for t in range(700)]
    turns = spark.createDataFrame(rows + [(2, 1, "user", "Alone.")], SCHEMA).repartition(8)
    assert cr.blocks(turns).filter("conv_id = 1").count() > 10
    assert as_repaired(cr.digests(turns)) == mended(filled(rows + [(2, 1, "user", "Alone.")]))


@pytest.mark.parametrize("seed", range(3))
def test_prices_are_costs_of_cheapest_paths(seed):
    rng = random.Random(seed)
    for _ in range(60):
        codes = "".join(chr(ord("a") + rng.randrange(16)) for _ in range(rng.randrange(1, 12)))
        ends = tuple(rng.randrange(6) for _ in range(4))
        arcs = cr.lattice(codes)
        prices = cr.auction(arcs, ends)
        assert all(prices[i] <= cost + prices[head] for i, here in enumerate(arcs) for _, cost, head in here)
        costs = [10**6] * (len(arcs) - 4) + list(ends)
        for _ in range(2 * len(arcs)):  # relaxed until nothing changes
            for i, here in enumerate(arcs):
                costs[i] = min([costs[i], *[cost + costs[head] for _, cost, head in here]])
        assert prices[:4] == costs[:4]
