"""Quality rules: a ledger of failure bits and measurements, and policies over it.

Every rule is evaluated once per document. Its bit is set in ``failures`` when the
document breaks it, and the numbers it looked at stay beside it. A policy is a named
set of rules; applying another version, or asking what a rule alone removes, needs
only the bits and never the text again.

Words are maximal runs of other characters than ``[\\x20\\x09-\\x0D]``. Repeated words
lie in a window of five words that occurs at least twice in the document; windows
are compared by 64-bit hashes of 64-bit word hashes.

Edge cases: a null or empty text has no words and breaks ``few_words``; repeated rows
and rows with a null id get a ledger row each; a text of any length is measured whole, within
its row; a measurement equal to a limit does not break the rule; an empty table gives an empty ledger;
other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

GAP = r"[\x20\x09-\x0D]+"
WINDOW = 5

RULES: dict[str, Column] = {}


def _rules() -> dict[str, Column]:
    """What breaks each rule, in the order of its bits. Never reorder; add at the end."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "few_words": n < 10,
        "repeated_words": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "repeated_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "short_words": chars < 2 * n,
        "long_words": chars > 20 * n,
        "capitals": 2 * F.col("n_capitals") > chars,
    }


BITS: dict[str, int] = {
    "few_words": 1, "repeated_words": 2, "symbols": 4, "repeated_lines": 8, "short_words": 16, "long_words": 32, "capitals": 64,
}
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": tuple(BITS),
}


def mask_of(policy: str) -> int:
    return sum(BITS[rule] for rule in POLICIES[policy])


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def measure(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All measurements of each document. No shuffle: repeats are found inside the row.

    Each array is a column of its own before a lambda looks into it, so that it is
    computed once per document.
    """
    text, words, hashes, windows, pairs = (F.col(c) for c in ("text", "words", "hashes", "windows", "pairs"))
    found = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    found = found.select(
        "doc_id",
        F.array_remove(F.split(text, GAP), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        _without(text, GAP).cast("bigint").alias("word_chars"),
        (F.length(text) - _without(text, r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.length(text) - _without(text, r"\p{Lu}")).cast("bigint").alias("n_capitals"))
    kept = ["doc_id", "word_chars", "n_symbols", "n_capitals"]
    found = found.select(
        *kept, F.size(words).cast("bigint").alias("n_words"), F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform(words, lambda word: F.xxhash64(word)).alias("hashes"))
    kept += ["n_words", "n_lines", "n_dup_lines"]
    found = found.select(*kept, F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))),
        lambda first, at: F.xxhash64(first, *[F.get(hashes, at + step) for step in range(1, WINDOW)])).alias("windows"))
    # Most texts repeat no window; only the others are sorted.
    found = found.select(*kept, F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda window, at: F.struct(window.alias("window"), at.alias("at"))))).alias("pairs"))
    twice = F.filter(pairs, lambda pair, i: (
        (pair["window"] == F.get(pairs, i + 1)["window"]) | (pair["window"] == F.get(pairs, F.greatest(i - 1, F.lit(0)))["window"]) & (i > 0)))
    found = found.select(*kept, F.sort_array(F.transform(twice, lambda pair: pair["at"])).alias("at"))
    covered = F.aggregate(
        "at", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda seen, at: F.struct(at.alias("last"), (seen["n"] + F.least(F.lit(WINDOW), at - seen["last"])).alias("n")),
        lambda seen: seen["n"])
    return found.select(*kept, F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_repeat_words"))


def ledger(docs: DataFrame, **columns: str) -> DataFrame:
    """Measurements and ``failures``, a bit for each broken rule."""
    bits = [F.when(broken, F.lit(BITS[rule])).otherwise(0) for rule, broken in _rules().items()]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return measure(docs, **columns).withColumn("failures", failures.cast("bigint"))


def passes(policy: str) -> Column:
    """Whether a ledger row breaks no rule of the policy."""
    return F.col("failures").bitwiseAND(F.lit(mask_of(policy))) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """``rule, n_failed, n_only``: documents that break the rule, and that this rule alone removes.

    Rows are first counted by their bits: at most two to the number of rules groups.
    """
    broken = F.col("failures").bitwiseAND(F.lit(mask_of(policy)))
    counts = rows.groupBy(broken.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).alias("bit")) for r in POLICIES[policy]]))
    each = counts.select("bits", "n", rules.alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"))


def verdicts(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger's digest: base measurements, ``base_failed`` and ``kept``."""
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base")).alias("base_failed"), (passes("base") & passes(policy)).alias("kept"), "failures")
