"""One key holds a third of all rows: results stay whole, and no task gets them all."""

import pytest

from tests.conftest import TABLES, plan_of, rows_of, settings
from wayprint.plans.jobs import run_job
from wayprint.plans.profiles import build_state
from wayprint.sources import Registry, frames

N = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_pieces(spark):
    with settings(spark, SETTINGS):
        yield


def _registry(spark, **given):
    empty = {n: spark.createDataFrame([], s) for n, s in TABLES.items()}
    return Registry(spark, frames({**empty, **given}))


def _hot(spark, columns, n=N):
    """A third of the rows share the key ``k``."""
    keyed = spark.range(n, numPartitions=8).selectExpr("id", "case when id % 3 = 0 then 'hot' else cast(id as string) end as k")
    return keyed.selectExpr(*columns)


def _heads(spark, user_id, n=N):
    """One order per key of ``_hot``."""
    return spark.range(n).filter("id = 0 or id % 3 > 0").selectExpr(
        "case when id = 0 then 'hot' else cast(id as string) end as order_no", f"{user_id} as user_id",
        "1d as actual_amount", "timestamp'2024-01-01' as cdate")


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_order_with_a_third_of_the_lines(spark, small_pieces):
    lines = _hot(spark, ["k as fd_code", "concat('R', hash(id) % 7) as fd_restaurant_code", "hash(id) / 8d as xfprice",
                         "timestamp'2024-01-01' as ordertime", "'c' as fd_class"])
    heads = _heads(spark, "id % 11")
    registry = _registry(spark, restaurant_order_detail2=lines, tb_order=heads)
    assert sum(n for _, n in rows_of(run_job(registry, "B05"), "user_id", "restConsumptionNum")) == N
    assert "skew=true" in _final_plan(run_job(registry, "A01"))


@pytest.mark.parametrize("users", [2, N])
def test_one_class_with_a_third_of_the_lines(spark, small_pieces, users):
    lines = _hot(spark, ["cast(id as string) as fd_code", "'R' as fd_restaurant_code", "1d as xfprice",
                         "timestamp'2024-01-01' as ordertime", "k as fd_class"])
    heads = spark.range(N).selectExpr("cast(id as string) as order_no", f"id % {users} as user_id", "1d as actual_amount",
                                      "timestamp'2024-01-01' as cdate")
    classes = spark.createDataFrame([("hot", "0"), ("hot", "1"), ("1", "1")], TABLES["restaurant_class"])
    registry = _registry(spark, restaurant_order_detail2=lines, tb_order=heads, restaurant_class=classes)
    state = build_state(registry, facts=["orders"])
    # Lines are summed by user and class before the join, and what still shares a class there is split.
    assert "explode" not in plan_of(state)
    sums = state.selectExpr("sum(order_n)", "sum(class_whole)", "sum(class_n)").first()
    assert tuple(sums) == (N, N // 3 + 1, 2 * (N // 3) + 1)
    if users == N:
        with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
            assert "skew=true" in _final_plan(build_state(registry, facts=["orders"]))


def test_one_card_with_a_third_of_the_visits_and_bindings(spark, small_pieces):
    visits = _hot(spark, ["k as dragoncode", "concat('N', id % 5) as loungecode", "2L as point", "1L as personcount",
                          "timestamp'2024-01-01' as consumetime"])
    bindings = _hot(spark, ["k as dragoncode", "id % 4 as user_id"], n=300)
    found = run_job(_registry(spark, tblconsumerecord=visits, tb_bindrecord=bindings), "B24")
    # 100 bindings of the hot card meet its 20,000 visits; 200 cards are bound and visit once.
    assert sum(n for _, n in rows_of(found, "user_id", "loungeUsageCounter")) == 100 * (N // 3) + 200


def test_one_order_with_a_third_of_the_transfer_records_and_products(spark, small_pieces):
    records = _hot(spark, ["k as order_no", "timestamp'2024-01-01' as create_time"], n=6000)
    products = _hot(spark, ["k as order_no", "concat('C', id % 3) as pro_code"], n=6000)
    heads = _heads(spark, "1L", n=6000)
    registry = _registry(spark, tb_order_cip_record=records, tb_order_cip=products, tb_order=heads)
    found = run_job(registry, "B14")
    assert rows_of(found, "user_id", "CIPUsageCounter") == [("1", 2000 * 2000 + 4000)]


def test_one_article_with_a_third_of_the_visits(spark, small_pieces):
    from wayprint.constants import ARTICLE_URL_PREFIX
    visits = _hot(spark, ["cast(id % 9 as string) as user_id", f"concat('{ARTICLE_URL_PREFIX}', k) as url", "timestamp'2024-01-01' as create_time"])
    labels = spark.createDataFrame([("hot", "十一"), ("1", None)], TABLES["tbd_belles_lettres"])
    found = run_job(_registry(spark, tbd_visit_url=visits, tbd_belles_lettres=labels), "B01")
    assert sum(r.eleven for r in found.collect()) == N // 3


def test_one_user_with_a_third_of_the_views(spark, small_pieces):
    views = _hot(spark, ["'/VirtualCard-v6/parking/items' as url", """concat('{"userId":"', k, '","parkingCode":"P"}') as param""",
                         "timestamp'2024-01-01' as create_time"])
    found = run_job(_registry(spark, tbd_url_element=views), "A09")
    assert found.filter("user_id = 'hot'").first().browseNum == N // 3
    assert found.count() == N - N // 3 + 1


@pytest.mark.parametrize("job, field", [("B35", "carConsumptionNum"), ("B33", "carAverageOrderAmount")])
def test_one_number_without_an_order_with_a_third_of_the_lines(spark, small_pieces, job, field):
    """Equal numbers compress to next to nothing, so Spark does not see them as a hot key; they are counted before the join."""
    lines = spark.range(N, numPartitions=8).selectExpr("case when id % 3 = 0 then 'none' else cast(id div 2 as string) end as order_no")
    heads = spark.range(N // 2).selectExpr("cast(id as string) as order_no", "id % 4 as user_id", "id % 4 + 0.5d as actual_amount", "timestamp'2024-01-01' as cdate")
    found = run_job(_registry(spark, tb_order_limousine=lines, tb_order=heads), job)
    plan = plan_of(found)
    assert "partial_count" in plan[plan.index("Join"):]
    values = [float(v) for _, v in rows_of(found, "user_id", field)]
    assert sum(values) == 2 * N // 3 if job == "B35" else sorted(values) == [0.5, 1.5, 2.5, 3.5]
