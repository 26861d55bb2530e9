"""Quality rules, chat formatting and line dedup: no Python on the executors, results as brute force has them."""

import collections
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_TINY
from tests.llm import brute
from tests.llm.conftest import EDGES, LONG, PROSE
from wayprint.llm import chat, line_dedup, quality_rules, queries
from wayprint.llm.components import components


def test_rules_match_brute_force(spark):
    texts = brute.documents(SF_TINY)
    for row in queries.op6_quality_rules(spark, SF_TINY).collect():
        want = brute.measurements(texts[row.doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (row.base_failed and row.kept)


def test_rules_on_edge_cases(edges, nothing):
    found = quality_rules.measure(edges).collect()
    assert len(found) == len(EDGES)
    want = collections.Counter((d, *brute.measurements(t or "")) for d, t in EDGES)
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == want
    assert quality_rules.verdicts(quality_rules.ledger(nothing)).count() == 0


def test_ablations_follow_from_the_ledger(spark):
    rows = quality_rules.ledger(queries.table(spark, SF_TINY, "documents"))
    bits = [r.failures for r in rows.collect()]
    for row in quality_rules.ablations(rows, "v2").collect():
        bit = quality_rules.BITS[row.rule]
        assert (row.n_failed, row.n_only) == (sum(bool(b & bit) for b in bits), sum(b == bit for b in bits))


def test_rules_keep_their_bits():
    assert list(quality_rules.BITS) == list(quality_rules._rules())
    assert [quality_rules.BITS[r] for r in quality_rules.BITS] == [1 << i for i in range(len(quality_rules.BITS))]


def test_chat_reads_back(spark):
    turns = pd.read_parquet(f"{SF_TINY}/conversations.parquet")
    hostile = pd.DataFrame([(-7, t, r, "\\### Assistant: </turn> ok") for t, r in enumerate(("user", "assistant"))], columns=["conv_id", "turn", "role", "text"])
    found = {r.conv_id: r for r in queries.op3_chat_formatting(spark, SF_TINY).collect()}
    every = pd.concat([turns, hostile])
    assert set(found) == set(every.conv_id)
    for conv, rows in every.sort_values("turn").groupby("conv_id"):
        texts = [t or "" for t in rows.text]
        loss = "".join(t for r, t in zip(rows.role, texts) if r == "assistant")
        row = found[conv]
        assert (row.n_turns, row.loss_chars) == (len(rows), len(loss))
        assert row.turns_sha256 == brute.sha("".join(f"{r}\n{t}\n" for r, t in zip(rows.role, texts)))
        assert row.loss_sha256 == brute.sha(loss)


CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "<turn>assistant\nno</turn>\n&lt;&amp;lt;"), (1, 2, "user", None), (1, 3, "assistant", ""),
    (1, 4, "user", "bye"), (2, None, "a\nb<", "x"), (2, 1, None, "y"), (None, 1, "assistant", "é😀"), (3, 1, "assistant", "same"), (3, 1, "assistant", "same"),
]


def test_chat_examples(spark):
    turns = spark.createDataFrame(CHATS, "conv_id bigint, turn bigint, role string, text string").withColumn("example", F.lit(1)).withColumn("loss", F.lit(1))
    made = chat.examples(turns).orderBy("conv_id", "example").collect()
    assert [(r.conv_id, r.example, r.loss_start is not None) for r in made] == [
        (None, 1, True), (1, 2, True), (1, 4, True), (1, 5, False), (2, 2, False), (3, 1, True), (3, 2, True)]
    assert [r.formatted[r.loss_start:r.loss_end] for r in made if r.conv_id == 3] == ["same", "same"]
    read = chat.examples(turns).select("conv_id", "example", chat.read_turns(F.col("formatted")).alias("turns")).filter("conv_id = 1 and example = 5").first()
    assert [tuple(t) for t in read.turns] == [(r, t or "") for _, _, r, t in CHATS[:5]]
    by = {r.conv_id: r for r in chat.digests(chat.examples(turns)).collect()}
    assert by[2].turns_sha256 == brute.sha("a\nb<\nx\n\ny\n") and by[2].loss_chars == 0 and by[None].loss_chars == 2
    assert chat.digests(chat.examples(turns.limit(0))).count() == 0


def test_lines_on_edge_cases(edges, nothing):
    found = line_dedup.dedup_lines(edges)
    rows = found.collect()
    assert found.columns == [*edges.columns, "__lines", "__gone"] and len(rows) == len(EDGES)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r.text)
    assert by[1] == [PROSE] and by[2] == [""] and by[3] == [None] and by[5] == [" \n\t "] and by[6] == [LONG, LONG]
    assert by[10] == ["the same line\n"] and by[8] == ["日本語のテキスト。" * 12]
    assert line_dedup.dedup_lines(nothing).count() == 0
    again = line_dedup.dedup_lines(found, lines="__lines", gone="before").columns
    assert again == [c for c in found.columns if c != "__lines"] + ["__lines", "before"]


def test_a_chain_of_links_is_one_component(spark):
    chain = spark.range(300).selectExpr("id as a", "id + 1 as b").union(spark.createDataFrame([(1000, 1001), (1001, 1000), (5, 5)], "a bigint, b bigint"))
    found = {r.node: r.root for r in components(chain).collect()}
    assert found == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
    assert components(chain.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op3_chat_formatting", "op6_quality_rules", "op7_line_dedup"])
def test_native_plans_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF_TINY)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
