import json

import pytest

from tests.conftest import TABLES, plan_of, rows_of
from wayprint.sources import (
    ONE_TASK, Registry, Split, count_rejected, document_values, documents_table, document_fields, format_row, frames, jdbc_database,
    parquet_directory, query_documents, read_documents, variant_documents,
)
from wayprint.sources.schemas import COLUMNS, DATABASE


def test_every_table_has_a_database_and_columns():
    assert set(DATABASE) == set(COLUMNS) == set(TABLES)


def test_tables_come_from_their_database(spark):
    asked = []

    def loader(database):
        def load(session, table):
            asked.append((database, table))
            return session.createDataFrame([], TABLES[table])
        return load

    registry = Registry(spark, {d: loader(d) for d in ("business", "business2", "log")})
    for table in ("tb_order", "customer_share", "tbd_visit_url", "tb_order"):
        assert registry.table(table).columns == list(COLUMNS[table])
    assert asked == [("business", "tb_order"), ("business2", "customer_share"), ("log", "tbd_visit_url")]


def test_parquet_directory_reads_by_name_in_any_column_order(spark, tmp_path):
    spark.createDataFrame([("x", "A", 7)], "note string, url string, user_id int").selectExpr(
        "url", "note", "user_id", "current_timestamp() as create_time").write.parquet(f"{tmp_path}/tbd_visit_url.parquet")
    visits = Registry(spark, parquet_directory(str(tmp_path))).table("tbd_visit_url")
    assert rows_of(visits, "user_id", "url") == [("7", "A")]


def test_users_become_text_once(spark):
    registry = Registry(spark, frames({"tb_bindrecord": spark.createDataFrame([("d", 1)], "dragoncode string, user_id bigint")}))
    assert dict(registry.table("tb_bindrecord").dtypes)["user_id"] == "string"


@pytest.mark.parametrize("split", [ONE_TASK, ["k < 'm'", "k >= 'm' or k is null"], Split("id", 1, 1000, 16)])
def test_database_tables_are_read_in_ranges(split):
    calls = []

    class Reader:
        def jdbc(self, *args, **kwargs):
            calls.append((args, kwargs))

    class Session:
        read = Reader()

    load = jdbc_database("jdbc:x", {"user": "u"}, {"t": split})
    load(Session(), "t")
    expected = {"properties": {"user": "u"}}
    if isinstance(split, list):
        expected["predicates"] = split
    if isinstance(split, Split):
        expected |= {"column": "id", "lowerBound": 1, "upperBound": 1000, "numPartitions": 16}
    assert calls == [(("jdbc:x", "t"), expected)]
    with pytest.raises(ValueError):
        load(Session(), "other")


def test_documents_by_name_not_by_position(spark, tmp_path):
    documents = [{"userId": 1, "isStop": False}, {"isStop": True, "userId": "2", "more": {"a": 1}}, {"userId": None}]
    path = tmp_path / "documents.json"
    path.write_text("\n".join(json.dumps(d) for d in documents))
    stored = read_documents(spark, str(path))
    assert dict(stored.dtypes)["userId"] == "string"
    found = query_documents(stored, "select userId, isStop from {documents}")
    assert {r[0] for r in found.select(format_row(userID="userId", isStop="isStop")).collect()} == {
        "userID:1|isStop:false", "userID:2|isStop:true", "userID:null|isStop:null"}


def test_documents_in_a_text_column(spark):
    texts = spark.createDataFrame([(None,), ('{"a":1,"b":"x"}',), ('{"b":"y","c":2}',), ("no json",)], "doc string").coalesce(1)
    assert document_fields(texts, "doc") == ["a", "b", "c"]
    assert {tuple(r) for r in documents_table(texts, "doc").collect()} == {("1", "x", None), (None, "y", "2"), (None, None, None)}
    assert documents_table(texts, "doc", ["c"]).columns == ["c"]
    assert document_fields(texts.limit(0), "doc") == [] == document_fields(texts.filter("doc = 'no json'"), "doc")


def test_fields_of_any_name(spark):
    names = ["it's", 'say "x"', "a.b", "with space", "$", "[0]", "both ' and \""]
    texts = spark.createDataFrame([(json.dumps({n: i for i, n in enumerate(names)}),), ("[1]",), ("3",)], "doc string").coalesce(1)
    assert document_fields(texts, "doc") == sorted(names)
    assert tuple(documents_table(texts, "doc", names).first()) == tuple(map(str, range(len(names))))
    assert sorted(tuple(r) for r in document_values(texts, "doc").collect()) == sorted((n, str(i)) for i, n in enumerate(names))


def test_values_take_one_scan(spark, tmp_path):
    spark.range(3).selectExpr("concat('{\"a\":', id, '}') as doc").write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    assert plan_of(document_values(stored, "doc")).count("FileScan") == 1
    assert plan_of(query_documents(variant_documents(stored, "doc"), "select try_variant_get(doc, '$.a', 'int') a from {documents}")).count("FileScan") == 1


def test_broken_lines_are_kept_and_counted(spark, tmp_path):
    path = tmp_path / "documents.json"
    path.write_text('{"userId":1,"isStop":true}\n{"userId":\nno json\n{"userId":"2"}\n[5\n')
    for read in (read_documents(spark, str(path)), read_documents(spark, str(path), ["userId", "isStop"])):
        assert rows_of(read, "userId", "isStop", "_rejected") == sorted([
            ("1", "true", None), ("2", None, None), (None, None, "no json"), (None, None, '{"userId":'), (None, None, "[5")], key=str)
        assert rows_of(count_rejected(read.cache()), "documents", "rejected") == [(2, 3)]
