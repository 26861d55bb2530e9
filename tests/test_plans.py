"""The plans are the ones wanted at scale."""

import datetime as dt

import pytest

from testbed.queries import all_queries
from testbed.standins import load, registry as standin_registry
from tests.conftest import SF_TINY, TABLES, plan_of, settings
from wayprint.constants import BROWSE_URLS
from wayprint.plans.facts import LABEL_PARTS, PARTS, Window
from wayprint.plans.jobs import run_job
from wayprint.plans.profiles import ITEM_PARTS, build_state, fact_rows, item_documents, user_documents
from wayprint.sources import Registry, parquet_directory

@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        yield


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """All sources as parquet, empty, so that what reaches the scans can be seen."""
    root = str(tmp_path_factory.mktemp("sources"))
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}.parquet")
    return Registry(spark, parquet_directory(root))


def test_no_query_leaves_the_jvm_or_multiplies_tables(spark, no_broadcast):
    for name, query in all_queries().items():
        plan = plan_of(query(spark, SF_TINY))
        if "_daily_" in name:
            assert "FullOuter" not in plan and "coalesce(user_id" not in plan, name
        for word in ("Python", "ExistingRDD", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
            assert word not in plan, (name, word)


def test_page_log_scan(stored):
    plan = plan_of(run_job(stored, "A05", Window.day_before(dt.date(2024, 1, 15))))
    assert "In(url, [" in plan
    assert "GreaterThanOrEqual(create_time" in plan and "LessThan(create_time" in plan
    assert plan.count("FileScan") == 1
    for url in BROWSE_URLS["rest"]:
        assert url in plan


def test_prefixes_reach_the_scan(stored):
    assert "StringStartsWith(url" in plan_of(run_job(stored, "A25"))
    assert "StringStartsWith(product,R)" in plan_of(run_job(stored, "A07"))


def test_only_used_columns_are_read(stored):
    plan = plan_of(run_job(stored, "A02"))
    assert "ReadSchema: struct<fd_code:string,fd_restaurant_code:string>" in plan
    assert "ReadSchema: struct<order_no:string,user_id:bigint>" in plan
    assert "xfprice" not in plan and "fd_class" not in plan


def test_left_joins_with_a_required_user_become_inner(stored, no_broadcast):
    for job in ("A01", "A08", "A12", "A13", "A14", "B26"):
        plan = plan_of(run_job(stored, job))
        assert "Inner" in plan and "LeftOuter" not in plan, job
        assert "IsNotNull(user_id)" in plan, job


def test_day_of_header_dated_orders_reaches_the_header(stored):
    plan = plan_of(run_job(stored, "B13", Window.day_before(dt.date(2024, 1, 15))))
    assert "GreaterThanOrEqual(cdate" in plan
    plan = plan_of(run_job(stored, "A02", Window.day_before(dt.date(2024, 1, 15))))
    assert "GreaterThanOrEqual(ordertime" in plan and "GreaterThanOrEqual(cdate" not in plan


@pytest.mark.parametrize("job", ["A02", "B24", "B13", "B14"])
def test_a_day_does_not_shuffle_a_full_table(stored, no_broadcast, job):
    """A full table is filtered by the day's keys before it is shuffled."""
    plan = plan_of(run_job(stored, job, Window.day_before(dt.date(2024, 1, 15))))
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan, job


def test_item_documents_read_no_classes(stored, no_broadcast):
    assert "restaurant_class" not in plan_of(item_documents(build_state(stored, parts=ITEM_PARTS)))


def test_the_state_reads_each_source_once(stored, no_broadcast):
    plan = plan_of(build_state(stored))
    scans = plan.count("FileScan parquet")
    # 18 source tables, the transfer products a second time for their records.
    assert scans == 19
    for table in ("tb_order", "tbd_url_element", "tbd_visit_url", "tb_user_collect", "restaurant_order_detail2", "tblconsumerecord"):
        assert plan.count(f"/{table}.parquet") == 1, table


def test_user_documents_read_the_visit_log_once(stored, no_broadcast):
    plan = plan_of(user_documents(fact_rows(stored, parts=[*PARTS, *LABEL_PARTS])))
    assert plan.count("/tbd_visit_url.parquet") == plan.count("/tb_order.parquet") == 1
    assert plan.count("FileScan parquet") == 20  # and the article labels


@pytest.mark.parametrize("job", ["A01", "B25"])
def test_lookups_are_not_repeated(stored, no_broadcast, job):
    assert "Generate explode" not in plan_of(run_job(stored, job))


def test_the_state_is_shuffled_once_after_the_joins(stored, no_broadcast):
    plan = plan_of(build_state(stored))
    top = plan[:plan.index("Union")]
    assert top.count("Exchange") == 1
    assert "partial_sum" in top


def test_documents_of_a_stored_state_shuffle_only_sums(spark, tmp_path):
    registry = standin_registry(spark, SF_TINY)
    build_state(registry).write.parquet(str(tmp_path / "state"))
    state = spark.read.parquet(str(tmp_path / "state"))
    assert "Exchange" not in plan_of(item_documents(state))
    plan = plan_of(user_documents(state))
    assert plan.count("Exchange hashpartitioning") == 2 and "partial_sum" in plan


def test_nothing_is_hinted(spark):
    for df in (fact_rows(standin_registry(spark, SF_TINY)), load("orders", spark, SF_TINY)):
        assert "ResolvedHint" not in df._jdf.queryExecution().optimizedPlan().toString()
