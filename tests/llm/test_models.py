"""Quality classifier, language model and fingerprints: accuracy, exact counts, brute force."""

import collections
import math
import re
import zlib

import numpy as np
import pandas as pd
import pytest

from tests.conftest import SF_SMALL, SF_TINY
from tests.llm import brute
from tests.llm.conftest import EDGES
from wayprint.llm import fingerprints, lm_scoring, quality_classifier, queries


def remainder(doc_id, of):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % of


def test_held_out_quality(spark):
    scores = queries.op1_quality_classifier(spark, SF_SMALL).toPandas()
    assert len(scores) == 1000 and scores.score.between(0, 1).all()
    assert (scores.predicted == (scores.score >= 0.7)).all()
    assert (scores.held_out == scores.doc_id.map(lambda d: remainder(d, 4) == 2)).all()
    known = scores.merge(pd.read_parquet(f"{SF_SMALL}/labels.parquet"), on="doc_id")
    held = known[known.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    # The stage keeps what the scores say.
    kept = quality_classifier.keep_good(queries.table(spark, SF_SMALL, "documents"), queries.table(spark, SF_SMALL, "labels"))
    assert abs(kept.count() - scores.predicted.sum()) <= 2


def test_labels_decide(spark, edges, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 1), (4, 0), (5, None), (99, 0), (None, 0)], "doc_id bigint, quality int")
    found = quality_classifier.score_documents(edges, labels).collect()
    assert len(found) == len(EDGES) and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in quality_classifier.score_documents(edges, labels.limit(0)).collect()} == {1.0}
    assert quality_classifier.score_documents(nothing, labels).count() == 0
    assert quality_classifier.keep_good(edges, labels.limit(0)).columns == edges.columns
    assert quality_classifier.keep_good(edges, labels.limit(0)).count() == len(EDGES)


def test_pools_rise():
    counts, sums = np.array([4, 4, 4, 4, 4]), np.array([0, 3, 1, 4, 4])
    pools = quality_classifier.pool(counts, sums)
    shares = [sums[a:b].sum() / counts[a:b].sum() for a, b in pools]
    assert shares == sorted(shares) and pools[0] == (0, 1) and pools[1] == (1, 3)


def test_counts_and_base_score(spark):
    texts, counts = brute.documents(SF_TINY), collections.Counter()
    tokens = {d: [*brute.WORD.findall(t.translate(brute.UPPER)), "\n"] for d, t in texts.items()}
    for d, found in tokens.items():
        if remainder(d, 5) != 1:
            counts.update(found)
    total, kinds = sum(counts.values()), len(counts)
    rows = queries.op10_lm_scoring(spark, SF_TINY).collect()
    assert len(rows) == len(texts)
    for row in rows:
        found = tokens[row.doc_id]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in found)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(found), sum(counts[t] > 0 for t in found), total)
        assert row.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score - r.base_score for r in held) > 0.5 * sum(r.n_tokens for r in held)


def plain_pair_weights(counts: dict, shares: dict) -> tuple[dict, float]:
    """Weights of a group by bisection on its normaliser, which must satisfy z = 1 + sum of share * (exp(weight) - 1)."""
    total = sum(counts.values())
    weights = lambda z: {w: max(0.0, math.log((c - lm_scoring.DISCOUNT) * z / (total * shares[w]))) for w, c in counts.items()}
    low, high = 1e-9, 1e9
    for _ in range(200):
        z = math.sqrt(low * high)
        excess = 1 + sum(shares[w] * math.expm1(v) for w, v in weights(z).items()) - z
        low, high = (z, high) if excess > 0 else (low, z)
    return weights(z), math.log(z)


def test_score_equals_plain_python(spark):
    """All factors again, from plain counts; of the model only the trained table is used."""
    full, sums, table = lm_scoring.fit(queries.table(spark, SF_TINY, "documents"))
    texts, counts, pairs = brute.documents(SF_TINY), collections.Counter(), collections.Counter()
    tokens = {d: [*(w.encode() for w in brute.WORD.findall(t.translate(brute.UPPER))), b"\n"] for d, t in texts.items()}
    for d, found in tokens.items():
        if remainder(d, 5) != 1:
            counts.update(found)
            pairs.update(zip([b"\n", *found], found))
    top = {w: i for i, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:lm_scoring.N_FREQUENT])}
    kind = lambda w: top.get(w, lm_scoring.N_FREQUENT + zlib.crc32(w[-2:]) % lm_scoring.N_SHAPES)
    in_class, kinds = collections.Counter(), collections.Counter()
    for w, c in counts.items():
        in_class[kind(w)] += c
        kinds[kind(w)] += 1
    share = lambda w: (counts[w] + 0.5) / (in_class[kind(w)] + 0.5 * (kinds[kind(w)] + 1))
    total, n_classes = sum(counts.values()), lm_scoring.N_CLASSES
    class_share = [(in_class[c] + 0.5 * (kinds[c] + 1)) / (total + 0.5 * (len(counts) + n_classes)) for c in range(n_classes)]
    assert sum(class_share) == pytest.approx(1) and len(table) == 1 << sums.bits
    groups, after = collections.defaultdict(dict), collections.defaultdict(collections.Counter)
    for (last, w), c in pairs.items():
        groups[last, kind(w)][w] = c
        after[last][kind(w)] += c
    solved = {}

    def row(last):
        n, seen = sum(after[last].values()), len(after[last])
        for c in range(n_classes):
            likely = (max(after[last][c] - 0.75, 0) + (0.75 * seen + 1) * class_share[c]) / (n + 1)
            yield max(-127, min(127, round(math.log(likely / class_share[c]) * 16))) / 16

    def log(last, second, third, w):
        m, bits = 0xFFFFFFFF, sums.bits
        one, two, three = (0 if x is None else lm_scoring.xxhash.xxh64_intdigest(x) & m for x in (last, second, third))
        places = [((one * 0x85EBCA6B & m) ^ two) * 0xC2B2AE35 & m, (two ^ 0x27D4EB2F) * 0x165667B1 & m, (three ^ 0x5BD1E995) * 0x9E3779B1 & m]
        before = b"\n" if last is None else last
        logits = np.array(list(row(before))) if before in after else np.zeros(n_classes)
        logits = logits + table[0] + sum(table[max(p >> (32 - bits), 1)].astype(float) for p in places)
        group = before, kind(w)
        if group not in solved:
            solved[group] = plain_pair_weights(groups[group], {x: share(x) for x in groups[group]}) if group in groups else ({}, 0.0)
        weights, z = solved[group]
        within = math.log(share(w)) + weights.get(w, 0.0) - z
        return (logits[kind(w)] - np.log(np.exp(logits).sum()) + within) / math.log(10)

    rows = {r.doc_id: r.score for r in queries.op10_lm_scoring(spark, SF_TINY).collect()}
    for d in [d for d in sorted(texts) if len(tokens[d]) < 3000][:60]:
        t = [None, None, None, *tokens[d]]
        plain = sum(log(t[i - 1], t[i - 2], t[i - 3], t[i]) for i in range(3, len(t)))
        assert rows[d] == pytest.approx(plain, rel=2e-4)


def test_probabilities_of_a_position_sum_to_one(spark):
    """Classes given any row of features; words of a class with its unknown token, given any last token."""
    chunks = lm_scoring.chunks_of(queries.table(spark, SF_TINY, "documents"), 1, 5).cache()
    known, sums = lm_scoring.count_tokens(chunks)
    ready = lm_scoring.prepared(chunks, known, sums.frequent)
    weights = lm_scoring.train(lm_scoring.completed(ready, sums), sums.start(), 2)
    rng = np.random.default_rng(0)
    found, own = rng.integers(1, 1 << sums.bits, (50, lm_scoring.N_FEATURES)), rng.integers(-127, 128, (50, lm_scoring.N_CLASSES)).astype(np.int8)
    assert np.allclose(lm_scoring.softmax(weights, found, own).sum(axis=1), 1, atol=1e-4)
    rows = known.collect()
    classes = lm_scoring.classes_of([bytes(r.token) for r in rows], sums.frequent)
    shares = np.bincount(classes, 10 ** sums.within_log(np.array([r.n for r in rows]), classes), lm_scoring.N_CLASSES)
    unknown = 10 ** sums.within_log(np.zeros(lm_scoring.N_CLASSES), np.arange(lm_scoring.N_CLASSES))
    assert np.allclose(shares + unknown, 1)
    pairs = lm_scoring.pairs_of(ready, sums)
    fitted = lm_scoring.fit_pairs(pairs).cache()
    rest = fitted.filter("token is null").toPandas().set_index("group")["add"].astype(float)
    share = pairs.filter("n > 0").select("group", "token", "share").distinct()
    both = fitted.filter("token is not null").join(share, ["group", "token"]).toPandas()
    both["likely"] = both.share * np.exp(both["add"].astype(float))
    sums_of = both.groupby("group").agg(likely=("likely", "sum"), share=("share", "sum"))
    assert len(sums_of) == len(rest) > 1000
    assert np.allclose(sums_of.likely + (1 - sums_of.share) * np.exp(rest[sums_of.index]), 1, atol=1e-4)


def test_pairs_are_asked_as_arrays(spark):
    """Weights and rows do not depend on which buckets a last token has; chunks are not shuffled again for them, and their files go."""
    ready = lm_scoring.prepared(chunks := lm_scoring.chunks_of(queries.table(spark, SF_TINY, "documents"), 1, 5).cache(), *_counted(chunks))
    _, sums = lm_scoring.count_tokens(chunks)
    asked = lm_scoring.asked_pairs(ready, lm_scoring.HOT, 64, 0)
    assert asked.count() == 64 // lm_scoring.PASSES * ready.count()  # a row for each bucket, and not for each pair
    found = []
    for hot in (lm_scoring.HOT, 20):
        full = lm_scoring.completed(ready, sums, hot)
        assert "Exchange" not in full._jdf.queryExecution().executedPlan().toString()
        table = full.toArrow()
        found.append([(c.number.as_py(), c.added(), c.rows) for c in sorted(lm_scoring._chunks(iter(table.to_batches())), key=lambda c: c.number.as_py())])
    for (a, added, rows), (b, again, same) in zip(*found, strict=True):
        assert a == b and np.allclose(added, again, atol=1e-5) and (rows == same).all() and len(set(added.tolist())) > 1000


def test_tokens_of_a_chunk_are_those_of_each_text(spark):
    """Words and ends are cut from all texts of a chunk at once, and classes come from a table."""
    texts = ["", " One  two\n", "\x0b\x1c é\u00a0Ü x", "a", None, "\t", "B\x00", "日本語 A", "end"]
    data, offsets = lm_scoring.utf8(lm_scoring.pa.array(texts, lm_scoring.pa.string()))
    found, sizes = lm_scoring.tokens_of(data, offsets)
    wanted = [[*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), lm_scoring.END] for t in texts]
    assert found.to_pylist() == [w for x in wanted for w in x] and sizes.tolist() == list(map(len, wanted))
    tokens, shapes = lm_scoring._spelled(found.dictionary_encode().dictionary)
    assert tokens == list(dict.fromkeys(w for x in wanted for w in x)) and (shapes == lm_scoring.shapes_of(tokens)).all()


def test_scoring_takes_answers_row_by_row(spark, monkeypatch):
    """One array of all answers for each chunk was copied whole by an aggregation, a sort and a join; files by chunk need none of these, and no exchange."""
    plans, store = {}, lm_scoring.stored
    monkeypatch.setattr(lm_scoring, "stored", lambda df, name: plans.update({name: df._jdf.queryExecution().executedPlan().toString()}) or store(df, name))
    lm_scoring.score_documents(queries.table(spark, SF_TINY, "documents"))
    assert "FlatMapCoGroupsInArrow" in plans["scores"]
    assert not any(x in plans["scores"] for x in ("collect_list", "Join", "Exchange"))


def test_training_reads_no_weights_of_pairs(spark):
    """They are most of a row's bytes; rows of last tokens are the same without them, and chunks are written by the tasks that cut them."""
    full, _, _ = lm_scoring.fit(queries.table(spark, SF_TINY, "documents"))
    found = []
    for rows in (full, full.rows):
        found.append([c.rows for c in sorted(lm_scoring._chunks(iter(rows.toArrow().to_batches())), key=lambda c: c.number.as_py())])
    assert "adds" not in full.rows.schema["answers"].dataType.elementType.names
    assert all((a == b).all() for a, b in zip(*found, strict=True)) and len(found[0])


def test_counts_are_asked_by_byte(spark):
    """Eight planes of a byte each, which answer as the counts themselves did."""
    chunks = lm_scoring.chunks_of(queries.table(spark, SF_TINY, "documents"), 1, 5).cache()
    known, sums = lm_scoring.count_tokens(chunks)
    row = lm_scoring.asked_pairs(lm_scoring.prepared(chunks, known, sums.frequent), lm_scoring.HOT, 64, 0).first()
    planes = np.frombuffer(row.counts, np.uint8).reshape(8, -1)
    assert planes.shape[1] == len(row.classes) and planes[0].any() and not planes[4:].any()


def _counted(chunks):
    known, sums = lm_scoring.count_tokens(chunks)
    return known, sums.frequent


def test_sums_of_runs():
    rng = np.random.default_rng(1)
    for n in range(1, 60):
        keys, values = np.sort(rng.integers(0, rng.integers(1, 30), n)), rng.random((n, 3))
        firsts = lm_scoring._runs(keys)
        assert np.allclose(lm_scoring._run_sums(values, firsts), np.add.reduceat(values, firsts, axis=0))


def test_groups_across_batches():
    """A group that spans batches comes whole, and each row once."""
    groups = np.repeat(np.arange(6), [1, 7, 2, 12, 1, 3])
    table = lm_scoring.pa.table({"group": groups, "n": np.arange(len(groups))})
    for size in (1, 2, 3, 5, 100):
        found = [t["group"].to_pylist() for t in lm_scoring._groups(iter(table.to_batches(max_chunksize=size)))]
        assert sum(found, []) == groups.tolist()
        assert all(a[-1] != b[0] for a, b in zip(found, found[1:]))


def test_language_model_on_edge_cases(edges, nothing):
    found = lm_scoring.score_documents(edges).collect()
    assert collections.Counter(r.doc_id for r in found) == collections.Counter(d for d, _ in EDGES)
    assert {r.n_tokens for r in found if r.doc_id in (3, 4, 5)} == {1}
    assert all(r.score < 0 for r in found)
    assert lm_scoring.score_documents(nothing).count() == 0
    alone = lm_scoring.score_documents(edges.filter("doc_id = 7 or doc_id = 9"), training=remainder(7, 5), modulus=5).collect()
    assert len(alone) == 2


def phrases(text: str) -> set[bytes]:
    data, seen, now = text.encode(), set(), b""
    for byte in data:
        now += bytes([byte])
        if now not in seen:
            seen.add(now)
            now = b""
    return seen


def test_edits_and_prints(spark):
    texts = brute.documents(SF_TINY)
    ids = sorted(texts, reverse=True)
    rows = {r.doc_id: r for r in queries.op4_fingerprints(spark, SF_TINY).collect()}
    assert set(rows) == set(ids)
    for at, d in enumerate(ids):
        text, following = texts[d], texts[ids[(at + 1) % len(ids)]]
        n = len(text) // 3
        edited, row = text[:len(text) - n] + following[:n], rows[d]
        assert (row.n_chars, row.edited_sha256) == (len(text), brute.sha(edited))
        assert row.edited_fingerprint == fingerprints.Parsed(edited).fingerprint.hex()
        assert row.near_next == fingerprints.likeness(bytes.fromhex(row.fingerprint), bytes.fromhex(rows[ids[(at + 1) % len(ids)]].fingerprint))
    assert np.mean([r.near_edited > r.near_next for r in rows.values()]) > 0.95


def test_prints_estimate_the_likeness_of_phrases():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    base = " ".join(rng.choice(words, 600))
    for share in (0.9, 0.5, 0.1):
        cut = int(len(base) * share)
        other = base[:cut] + " ".join(rng.choice(words, 600))[:len(base) - cut].upper()
        a, b = phrases(base), phrases(other)
        found = fingerprints.likeness(fingerprints.Parsed(base).fingerprint, fingerprints.Parsed(other).fingerprint)
        assert found == pytest.approx(len(a & b) / len(a | b), abs=0.15)


def test_fingerprints_on_edge_cases(spark, edges, nothing):
    rows = fingerprints.fingerprints(edges).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(d for d, _ in EDGES)
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[1] == prints[2] and prints[3] == prints[4]
    assert fingerprints.fingerprints(nothing).count() == 0
    alone = fingerprints.fingerprints(spark.createDataFrame([(1, "abcabcabc")], "doc_id bigint, text string")).collect()
    assert [r.edited_sha256 for r in alone] == [brute.sha("abcabcabc")] and alone[0].near_next == 1
