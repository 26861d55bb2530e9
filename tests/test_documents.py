"""The document store: merges rewrite what they change, and writers do not lose each other's."""

import pytest

from tests.conftest import rows_of
from wayprint.plans.store import Conflict, DocumentStore, shared_root


def docs(spark, *rows, more="n int"):
    return spark.createDataFrame(list(rows), f"user_id string, {more}")


def test_only_changed_buckets_are_rewritten(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path), ["user_id"], buckets=32)
    store.merge(docs(spark, *[(str(i), i) for i in range(500)]))
    before = store.manifest()["folders"]
    assert len(before) == 32
    assert store.merge(docs(spark, ("7", 70), ("new", 1), more="m int")) == 2
    after = store.manifest()["folders"]
    assert 1 <= sum(before[b] != after[b] for b in before) <= 2
    found = {r.user_id: (r.n, r.m) for r in store.read().collect()}
    assert len(found) == 501 and found["7"] == (7, 70) and found["new"] == (None, 1) and found["8"] == (8, None)


def test_two_writers_of_one_bucket_both_land(spark, tmp_path):
    """The second writer finds the first one's version when it commits, and merges again."""
    mine, theirs = (DocumentStore(spark, str(tmp_path), ["user_id"], buckets=1) for _ in range(2))
    mine.merge(docs(spark, ("1", 1), ("2", 2)))
    calls = []

    def meanwhile():
        if not calls:
            calls.append(theirs.merge(docs(spark, ("1", 5), ("3", 3), more="m int")))

    assert mine.merge(docs(spark, ("1", 10), ("4", 4)), before_commit=meanwhile) == 3
    assert calls == [2]
    assert rows_of(mine.read(), "user_id", "n", "m") == [("1", 10, 5), ("2", 2, None), ("3", None, 3), ("4", 4, None)]


def test_writers_of_different_buckets_write_once(spark, tmp_path):
    mine, theirs = (DocumentStore(spark, str(tmp_path), ["user_id"], buckets=64) for _ in range(2))
    mine.merge(docs(spark, *[(str(i), i) for i in range(200)]))
    written, real = [], mine._merged
    mine._merged = lambda *args: written.append(args[-1]) or real(*args)
    first = [True]

    def meanwhile():
        if first.pop() if first else False:
            theirs.merge(docs(spark, ("1", 100)))

    mine.merge(docs(spark, ("2", 200)), before_commit=meanwhile)
    assert len(written) == 1
    found = {r.user_id: r.n for r in mine.read().collect()}
    assert (found["1"], found["2"], len(found)) == (100, 200, 200)


def test_a_writer_that_always_comes_second_gives_up(spark, tmp_path):
    mine, theirs = (DocumentStore(spark, str(tmp_path), ["user_id"], buckets=1) for _ in range(2))
    with pytest.raises(Conflict):
        mine.merge(docs(spark, ("1", 1)), attempts=2, before_commit=lambda: theirs.merge(docs(spark, ("2", 2))))
    assert rows_of(mine.read(), "user_id", "n") == [("2", 2)]


def test_old_versions_and_unnamed_data_go(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path), ["user_id"], buckets=4)
    for i in range(3):
        store.merge(docs(spark, *[(str(k), i) for k in range(20)]))
    assert len(list(tmp_path.glob("data/*/_part=*"))) == 12 and not list(tmp_path.glob("staged/*"))
    store.discard_old()
    assert len(list(tmp_path.glob("data/*/_part=*"))) == 4 and len(list(tmp_path.glob("manifests/*.json"))) == 1
    assert {r.n for r in store.read().collect()} == {2} and store.read().count() == 20
    with pytest.raises(ValueError):
        DocumentStore(spark, str(tmp_path), ["other"]).read()
    with pytest.raises(FileNotFoundError):
        DocumentStore(spark, str(tmp_path / "none"), ["user_id"]).read()


def test_null_keys_and_empty_changes(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path), ["user_id"], buckets=4)
    store.merge(docs(spark, (None, 1), ("a", 2)))
    store.merge(docs(spark, (None, 3)))
    store.merge(docs(spark, ("x", 1)).limit(0))
    assert rows_of(store.read(), "user_id", "n") == [("a", 2), (None, 3)]


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://somewhere"

    class Session:
        sparkContext = Context()
        conf = spark.conf

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError):
            shared_root(Session())
    assert shared_root(spark)
