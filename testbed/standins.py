"""Source tables made from the test tables.

Each is a projection of one whole test table, row for row, written in SQL that Spark
and DuckDB both read. Values are chosen so that the awkward cases occur: lines without
an order or with one that no header has, orders without a user, amounts that are missing
or have more than four decimals, texts that are no JSON, fields that few documents have.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wayprint.constants import ARTICLE_LABELS, ARTICLE_URL_PREFIX, BANNER_URL_PREFIXES, BROWSE_URLS
from wayprint.sources import Registry
from wayprint.sources.schemas import COLUMNS


@dataclass(frozen=True)
class StandIn:
    base: str
    columns: dict[str, str]

    def sql(self) -> str:
        columns = ", ".join(f"{e} AS {c}" for c, e in self.columns.items())
        return f"SELECT {columns} FROM {self.base}"


def _one_of(index: str, values: list[str]) -> str:
    """The value at an index from 0."""
    return f"split_part('{'|'.join(values)}', '|', CAST({index} + 1 AS INT))"


_URLS = [u for urls in BROWSE_URLS.values() for u in urls] + ["/VirtualCard-v6/other"]
_BANNERS = list(BANNER_URL_PREFIXES.values())
_LABELS = list(ARTICLE_LABELS.values())
_K = """replace(replace(props, '{"k": ', ''), '}', '')"""
_LETTER = _one_of("event_id % 5", ["R", "N", "F", "M", "X"])
_TEXT_USER = "CAST(user_id AS STRING)"

STANDINS = {
    "tb_order": StandIn("orders", {
        "order_no": "o_orderkey",
        "user_id": "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN NULL ELSE o_custkey END",
        "actual_amount": "CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN NULL ELSE o_totalprice + (o_orderkey % 7) * 1e-5 END",
        "cdate": "o_orderdate",
    }),
    "restaurant_order_detail2": StandIn("lineitem", {
        "fd_code": "CASE WHEN l_linenumber = 7 THEN -1 ELSE l_orderkey END",
        "fd_restaurant_code": "CASE WHEN l_quantity = 2 THEN NULL ELSE concat('R', CAST(l_partkey AS STRING)) END",
        "xfprice": "CASE WHEN l_quantity = 1 THEN NULL ELSE l_extendedprice END",
        "ordertime": "l_shipdate",
        "fd_class": "l_partkey",
    }),
    "td_restaurant_order": StandIn("lineitem", {
        "fd_code": "CASE WHEN l_linestatus = 'O' THEN l_orderkey END",
        "fd_restaurant_code": "concat('R', CAST(l_suppkey AS STRING))", "fd_date": "l_shipdate",
    }),
    "tb_order_parking": StandIn("lineitem", {
        "order_no": "CASE WHEN l_returnflag = 'A' THEN l_orderkey WHEN l_returnflag = 'R' THEN -l_orderkey END",
        "parking_code": "concat('P', CAST(l_suppkey AS STRING))",
        "create_date": "CAST(l_shipdate AS DATE)",
    }),
    "tb_order_cip": StandIn("lineitem", {
        "order_no": "CASE WHEN l_returnflag = 'R' THEN l_orderkey WHEN l_returnflag = 'A' THEN -l_orderkey END",
        "pro_code": "CASE WHEN l_quantity = 3 THEN NULL ELSE concat('C', CAST(l_suppkey AS STRING)) END",
    }),
    "tb_order_cip_record": StandIn("lineitem", {
        "order_no": "CASE WHEN l_linestatus = 'F' THEN l_orderkey END", "create_time": "l_shipdate",
    }),
    "tb_order_vvip": StandIn("lineitem", {
        "order_no": "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN l_orderkey END",
    }),
    "tb_order_limousine": StandIn("lineitem", {
        "order_no": "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN l_orderkey WHEN l_returnflag = 'A' THEN -1 END",
    }),
    "tblconsumerecord": StandIn("lineitem", {
        "dragoncode": "l_orderkey",
        "loungecode": "CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 5 THEN concat('X', CAST(l_suppkey AS STRING)) "
                      "ELSE concat('N', CAST(l_suppkey AS STRING)) END",
        "point": "CAST(l_quantity AS BIGINT)", "personcount": "CAST(l_linenumber AS BIGINT)", "consumetime": "l_shipdate",
    }),
    "tb_bindrecord": StandIn("orders", {"dragoncode": "o_orderkey", "user_id": "o_custkey"}),
    "tb_order_loungeserv": StandIn("lineitem", {
        "dragoncode": "CASE WHEN l_returnflag = 'N' THEN l_orderkey WHEN l_returnflag = 'A' THEN -l_orderkey END",
        "lounge_code": "concat('N', CAST(l_suppkey AS STRING), CASE WHEN l_linenumber = 1 THEN ',,' "
                       "WHEN l_linenumber = 2 THEN ',,N1' ELSE concat(',N', CAST(l_linenumber AS STRING)) END)",
        "create_date": "CAST(l_shipdate AS DATE)",
    }),
    "tb_user_collect": StandIn("events", {
        "user_id": "user_id", "code": f"concat({_LETTER}, {_K})", "create_time": "ts",
    }),
    "customer_share": StandIn("events", {
        "user_id": "CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS INT) END",
        "code": f"CASE WHEN event_type = 'click' THEN NULL ELSE concat({_LETTER}, {_K}) END", "create_time": "ts",
    }),
    "tb_customer_share": StandIn("events", {
        "user_id": "user_id", "code": f"concat({_LETTER}, {_K})",
        "score": "CASE WHEN event_type = 'error' THEN NULL ELSE value END", "create_time": "ts",
    }),
    "tbd_url_element": StandIn("events", {
        "url": _one_of(f"event_id % {len(_URLS)}", _URLS),
        "param": f"""CASE event_id % 19
            WHEN 0 THEN 'not json' WHEN 1 THEN '{{"userId":null,"code":"R1"}}' WHEN 2 THEN '{{"code":"R1"}}'
            WHEN 3 THEN '{{"userId":"","code":"R1"}}' WHEN 4 THEN NULL WHEN 5 THEN '[1]'
            WHEN 6 THEN concat('{{"userId":', {_TEXT_USER}, '}}')
            WHEN 7 THEN concat('{{"userId":"', {_TEXT_USER}, '","code":"","parkingCode":""}}')
            ELSE concat('{{"userId":', {_TEXT_USER}, ',"code":"S', {_K}, '","parkingCode":"P', {_K}, '"}}') END""",
        "create_time": "ts",
    }),
    "tbd_visit_url": StandIn("events", {
        "user_id": f"CASE WHEN event_id % 13 = 0 THEN NULL ELSE {_TEXT_USER} END",
        "url": f"""CASE event_type
            WHEN 'view' THEN concat('{ARTICLE_URL_PREFIX}', {_K}, '?from=app')
            WHEN 'click' THEN concat('{ARTICLE_URL_PREFIX}', {_K})
            WHEN 'purchase' THEN concat({_one_of("event_id % 12", _BANNERS)}, '/x?y=1')
            WHEN 'signup' THEN '{ARTICLE_URL_PREFIX}'
            ELSE 'https://www.example.com' END""",
        "create_time": "ts",
    }),
    "tbd_lettres_favor": StandIn("events", {
        "user_id": f"CASE WHEN event_id % 13 = 0 THEN NULL ELSE {_TEXT_USER} END",
        "lettres_id": f"CASE WHEN event_type = 'signup' THEN {_K} END", "create_time": "ts",
    }),
    "tbd_belles_lettres": StandIn("part", {
        "id": "CASE WHEN p_type = 'PROMO' THEN concat('x', CAST(p_partkey AS STRING)) ELSE CAST(p_partkey AS STRING) END",
        "person_labels": f"CASE WHEN p_type = 'LARGE' THEN NULL ELSE concat({_one_of('p_size % 5', _LABELS)}, ',', "
                         f"{_one_of('p_partkey % 7', _LABELS)}) END",
    }),
    "itd_restaurant": StandIn("part", {
        "fd_code": "concat('R', CAST(p_partkey AS STRING))",
        "fd_lg": "CASE WHEN p_type = 'ECONOMY' THEN 'zh-cn' WHEN p_type = 'SMALL' THEN NULL ELSE 'en' END",
        "fd_iscoupon": "CASE WHEN p_size % 5 = 0 THEN CAST(1 AS BIGINT) WHEN p_size % 5 = 1 THEN NULL ELSE CAST(0 AS BIGINT) END",
        "fd_isflashsale": "CASE WHEN p_size % 7 = 0 THEN CAST(1 AS BIGINT) WHEN p_size % 7 = 1 THEN NULL ELSE CAST(0 AS BIGINT) END",
        "fd_settlementdiscount": "CASE WHEN p_size % 3 = 0 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END",
    }),
    "restaurant_class": StandIn("part", {
        "fd_class": "p_partkey",
        "fd_cls": "CASE WHEN p_size >= 25 THEN '1' WHEN p_size < 5 THEN NULL WHEN p_size = 7 THEN 'n/a' ELSE '0' END",
    }),
    "tbd_app_opera_path": StandIn("events", {"id": "event_id"}),
    "tb_user": StandIn("customer", {"id": "c_custkey"}),
}


def load(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One test table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def registry(spark: SparkSession, sf_dir: str) -> Registry:
    """All source tables, made from the test tables of a folder."""
    bases: dict[str, DataFrame] = {}

    def loader(spark: SparkSession, name: str) -> DataFrame:
        source = STANDINS[name]
        if source.base not in bases:
            bases[source.base] = load(source.base, spark, sf_dir)
        return bases[source.base].selectExpr(*[f"{e} AS {c}" for c, e in source.columns.items()])

    return Registry(spark, loader)


def with_sources(*names: str) -> str:
    """WITH clause that defines the named source tables in SQL."""
    known = {**STANDINS, "user_flight": DOCUMENTS}
    return "WITH " + ",\n".join(f"{n} AS ({known[n].sql()})" for n in names)


# Stored documents, as JSON text; the second field is missing from some.
DOCUMENTS = StandIn("events", {
    "doc": f"""concat('{{"userId":', CASE WHEN event_type = 'error' THEN 'null' ELSE {_TEXT_USER} END,
        CASE WHEN event_id % 4 = 3 THEN '' ELSE concat(',"isStop":', CASE WHEN value > 2 THEN 'true' ELSE 'false' END) END,
        CASE WHEN event_id % 97 = 96 THEN ',"late":1' ELSE '' END, '}}')""",
})

assert set(STANDINS) == set(COLUMNS)
