import itertools

from pyspark.sql import functions as F

from tests.conftest import plan_of, rows_of
from wayprint.operators import (
    apply_increment, attach, count_by, distinct_total, integer_mean_by, label_sums_by,
    majority_label_by, mean_and_count_by, mean_by, merge_fields, merge_into, only_keys, paired_count_by, prefix_lookup, repeat_flag_by,
    sum_by, total,
)

ORDERS = "user_id string, item_code string, amount double"
ROWS = [("1", "23", 10.0), ("1", "23", 20.0), ("12", "3", 5.0), ("12", "3", None), ("2", None, 1.0)]
KEYS = ["user_id", "item_code"]


def test_grouped_measures(spark):
    df = spark.createDataFrame(ROWS, ORDERS)
    assert rows_of(count_by(df, KEYS, "n"), *KEYS, "n") == [("1", "23", 2), ("12", "3", 2), ("2", None, 1)]
    assert rows_of(count_by(df, KEYS, "n", having="n > 1"), "user_id") == [("1",), ("12",)]
    assert rows_of(mean_by(df, KEYS, "amount", "m"), *KEYS, "m") == [("1", "23", 15.0), ("12", "3", 5.0), ("2", None, 1.0)]
    assert rows_of(mean_and_count_by(df, ["user_id"], "amount", "m", "n"), "user_id", "m", "n") == [
        ("1", 15.0, 2), ("12", 5.0, 1), ("2", 1.0, 1)]
    assert rows_of(integer_mean_by(df, ["user_id"], "amount", "m"), "user_id", "m") == [("1", 15), ("12", 5), ("2", 1)]
    assert rows_of(sum_by(df, ["user_id"], "amount", "s"), "user_id", "s") == [("1", 30.0), ("12", 5.0), ("2", 1.0)]
    assert rows_of(repeat_flag_by(df, KEYS, "again"), "user_id", "again") == [("1", True), ("12", True), ("2", False)]


def test_labels_and_majority(spark):
    df = spark.createDataFrame(
        [("1", "a b", "1"), ("1", "b", "0"), ("2", "c", "0"), ("2", None, "n/a"), ("3", "c", None)], "u string, t string, c string")
    assert rows_of(label_sums_by(df, ["u"], "t", {"a": "a", "b": "b"}), "u", "a", "b") == [("1", 1, 2), ("2", 0, 0), ("3", 0, 0)]
    assert rows_of(majority_label_by(df, ["u"], "c", "p", labels=("hi", "lo")), "u", "p") == [("1", "hi"), ("2", "lo")]


def test_totals(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    assert total(df, "n").first().n == 4
    assert distinct_total(df, "id", "n").first().n == 2


def test_attach_keeps_or_requires(spark):
    lines = spark.createDataFrame([("o1", 1), ("o2", 2), ("o3", 3), (None, 4)], "order_no string, line int")
    heads = spark.createDataFrame([("o1", "u1"), ("o2", None), (None, "u9")], "order_no string, user_id string")
    every = attach(lines, heads, {"order_no": "order_no"})
    assert every.columns == ["order_no", "line", "user_id"]
    assert rows_of(every, "line", "user_id") == [(1, "u1"), (2, None), (3, None), (4, None)]
    known = attach(lines, heads, {"order_no": "order_no"}, require=["user_id"])
    assert rows_of(known, "line", "user_id") == [(1, "u1")]
    assert "LeftOuter" not in plan_of(known)


def test_paired_counts_equal_a_product_of_all_rows(spark):
    left = spark.range(3)
    right = spark.createDataFrame([("u", "a"), ("u", "a"), ("v", "b"), (None, "c")], "user_id string, item_code string")
    found = paired_count_by(left, right, KEYS, "n")
    pairs = itertools.product(range(3), [("u", "a"), ("u", "a"), ("v", "b")])
    expected = {}
    for _, key in pairs:
        expected[key] = expected.get(key, 0) + 1
    assert {(r.user_id, r.item_code): r.n for r in found.collect()} == expected
    assert not any(word in plan_of(found) for word in ("NestedLoop", "Cartesian"))

    assert paired_count_by(spark.range(0), right, KEYS, "n").count() == 0


def test_merge_fields_in_any_order(spark):
    parts = [
        spark.createDataFrame([("1", 5), ("2", 6)], "user_id string, a int"),
        spark.createDataFrame([("2", True)], "user_id string, b boolean"),
        spark.createDataFrame([("3", "x")], "user_id string, c string"),
    ]
    expected = [("1", 5, None, None), ("2", 6, True, None), ("3", None, None, "x")]
    for order in itertools.permutations(parts):
        assert rows_of(merge_fields(order, ["user_id"]), "user_id", "a", "b", "c") == expected


def test_merge_into_stored(spark):
    stored = spark.createDataFrame([("1", 1, "old"), ("2", 2, "keep")], "user_id string, n int, name string")
    changes = spark.createDataFrame([("1", 9, 7), ("3", 3, 8)], "user_id string, n int, m int")
    assert rows_of(merge_into(stored, changes, ["user_id"]), "user_id", "n", "name", "m") == [
        ("1", 9, "old", 7), ("2", 2, "keep", None), ("3", 3, None, 8)]


def test_increment_state_cases(spark):
    stored = spark.createDataFrame(
        [("has", "i", 4, "doc"), ("missing", "i", None, "doc"), ("quiet", None, 2, "doc"), ("none", "i", None, "doc")],
        "user_id string, item_code string, n bigint, other string")
    day = spark.createDataFrame([("has", "i", 1), ("missing", "i", 2), ("new", "i", 3), ("quiet", None, 5)],
                                "user_id string, item_code string, n bigint")
    expected = [("has", 5, "doc"), ("missing", 2, "doc"), ("new", 3, None), ("none", None, "doc"), ("quiet", 7, "doc")]
    assert rows_of(apply_increment(stored, day, KEYS), "user_id", "n", "other") == expected
    assert rows_of(apply_increment(stored, day, KEYS), "user_id", "n", "other") == expected
    assert rows_of(apply_increment(stored, day.limit(0), KEYS), "user_id", "n") == rows_of(stored, "user_id", "n")


def test_null_keys_survive_grouping(spark):
    df = spark.createDataFrame([("u", None), ("u", None)], "user_id string, item_code string")
    counted = count_by(df, KEYS, "n")
    assert rows_of(apply_increment(counted, counted, KEYS), *KEYS, "n") == [("u", None, 4)]
    assert counted.filter(F.col("item_code").isNull()).count() == 1


def test_means_keep_every_amount(spark):
    def of(*values, kind="double"):
        return spark.createDataFrame([("u", v) for v in values], f"user_id string, v {kind}")

    assert mean_by(of(1e15, 1.0), ["user_id"], "v", "m").first().m == (1e15 + 1) / 2
    assert mean_by(of("n/a", "4", kind="string"), ["user_id"], "v", "m").first().m == 4.0
    assert integer_mean_by(of(1.99999), ["user_id"], "v", "m").first().m == 1
    assert integer_mean_by(of(1.999999999), ["user_id"], "v", "m").first().m == 1
    assert mean_by(of(1e-9), ["user_id"], "v", "m").first().m == 1e-9
    assert majority_label_by(of("0.4999999999", kind="string"), ["user_id"], "v", "m", ("a", "b")).first().m == "b"
    assert majority_label_by(of("0.49996", kind="string"), ["user_id"], "v", "m", ("a", "b")).first().m == "b"
    assert majority_label_by(of("0", "1", kind="string"), ["user_id"], "v", "m", ("a", "b")).first().m == "a"
    found = mean_and_count_by(of(None, 2.0, 3.0), ["user_id"], "v", "m", "n").first()
    assert (found.m, found.n) == (2.5, 2)


def test_counted_rows_weigh_as_many(spark):
    df = spark.createDataFrame([("u", "1", 3), ("u", "0", 4), ("w", "1", 4), ("w", "0", 4)], "user_id string, v string, n bigint")
    found = majority_label_by(df, ["user_id"], "v", "m", ("a", "b"), rows="n")
    assert rows_of(found, "user_id", "m") == [("u", "b"), ("w", "a")]


def test_numbers_of_any_type_are_compared_as_numbers(spark):
    lines = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k bigint, line string")
    for kind in ("decimal(10,2)", "double", "int", "bigint", "string"):
        heads = spark.createDataFrame([(1, "u")], "key int, user_id string").withColumn("key", F.col("key").cast(kind))
        assert rows_of(attach(lines, heads, {"k": "key"}), "line", "user_id") == [("a", "u"), ("b", None), ("c", None)], kind


def test_numbers_and_text_are_compared_as_text(spark):
    lines = spark.createDataFrame([("1", "a"), ("x", "b")], "k string, line string")
    heads = spark.createDataFrame([(1, "u")], "key bigint, user_id string")
    assert rows_of(attach(lines, heads, {"k": "key"}), "line", "user_id") == [("a", "u"), ("b", None)]


def test_only_keys_of_a_span(spark):
    big = spark.range(1000).selectExpr("cast(id % 100 as string) as k", "id")
    few = spark.createDataFrame([("3",), ("3",), (None,), ("nowhere",)], "k string")
    assert only_keys(big, few, "k").count() == only_keys(big, few, "k", most=1).count() == 10
    assert "BroadcastExchange" in plan_of(only_keys(big, few, "k"))


def test_prefixes_from_a_table(spark):
    prefixes = spark.createDataFrame(
        [("https://a.com", "a"), ("https://a.com/x/", "ax"), ("https://a.com/x/y", "axy"), ("https://b.com/z", "bz"), (None, "n"), ("no url", "x")], "prefix string, id string")
    urls = ["https://a.com/x/yes", "https://a.com/q", "https://b.com/q", "https://a.com.evil/x", None, "https://b.com/z?1"]
    found = prefix_lookup(spark.createDataFrame([(u,) for u in urls], "url string"), "url", prefixes, "hit")
    assert {r.url: r.hit for r in found.collect()} == dict(zip(urls, ["axy", "a", None, None, None, "bz"]))
    assert not any(word in plan_of(found) for word in ("NestedLoop", "Cartesian"))


def test_a_host_with_very_many_prefixes(spark):
    """No row holds the prefixes of a host, and a URL meets as many cuts as prefixes have lengths."""
    prefixes = spark.range(100_000).selectExpr("concat('https://a.com/p', id, '/') as prefix", "cast(id as string) as id")
    prefixes = prefixes.unionByName(spark.createDataFrame([("https://a.com", "host"), ("https://a.com/p7/", "7b")], "prefix string, id string"))
    urls = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'https://a.com/hot?x' else concat('https://a.com/p', id, '/q?y=1') end as url")
    found = {r.id: r.hit for r in prefix_lookup(urls, "url", prefixes, "hit").collect()}
    assert found == {i: "host" if i % 3 == 0 else "7b" if i == 7 else str(i) for i in range(3000)}
