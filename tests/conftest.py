import os
import sys
from contextlib import contextmanager

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wayprint.sources import Registry, frames  # noqa: E402

SF_TINY, SF_SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

# Source tables of the tests, with the types the real ones have.
TABLES = {
    "tb_order": "order_no string, user_id bigint, actual_amount double, cdate timestamp",
    "restaurant_order_detail2": "fd_code string, fd_restaurant_code string, xfprice double, ordertime timestamp, fd_class string",
    "td_restaurant_order": "fd_code string, fd_restaurant_code string, fd_date timestamp",
    "tb_order_parking": "order_no string, parking_code string, create_date date",
    "tb_order_cip": "order_no string, pro_code string",
    "tb_order_cip_record": "order_no string, create_time timestamp",
    "tb_order_vvip": "order_no string",
    "tb_order_limousine": "order_no string",
    "tblconsumerecord": "dragoncode string, loungecode string, point bigint, personcount bigint, consumetime timestamp",
    "tb_bindrecord": "dragoncode string, user_id bigint",
    "tb_order_loungeserv": "dragoncode string, lounge_code string, create_date date",
    "tb_user_collect": "id bigint, owner bigint, kind int, product string, added timestamp",
    "customer_share": "id bigint, owner int, a int, b int, added timestamp, product string",
    "tb_customer_share": "user_id bigint, code string, score double, create_time timestamp",
    "tbd_url_element": "url string, param string, create_time timestamp",
    "tbd_visit_url": "user_id string, url string, create_time timestamp",
    "tbd_lettres_favor": "user_id string, lettres_id string, create_time timestamp",
    "tbd_belles_lettres": "id string, person_labels string",
    "itd_restaurant": "fd_code string, fd_lg string, fd_iscoupon bigint, fd_isflashsale bigint, fd_settlementdiscount bigint",
    "restaurant_class": "fd_class string, fd_cls string",
    "tbd_app_opera_path": "id bigint",
    "tb_user": "id bigint",
}


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.maxMetadataStringLength", "100000")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark):
    """Makes a registry from literal rows; tables not given are empty."""
    def make(**rows):
        return Registry(spark, frames({
            name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in TABLES.items()
        }))
    return make


@contextmanager
def settings(spark, values):
    """Session settings for the length of a block."""
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in values:
            spark.conf.unset(k)


def rows_of(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def plan_of(df):
    """Physical plan before execution."""
    return df._jdf.queryExecution().executedPlan().toString()
