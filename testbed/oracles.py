"""The registered queries as SQL, written from the definition of each metric.

Nothing here uses the package's operators: only the fixed values and the
definitions of the stand-in tables are shared.
"""

from __future__ import annotations

from testbed.standins import DOCUMENTS, with_sources
from wayprint.constants import ARTICLE_LABELS, ARTICLE_URL_PREFIX, BANNER_URL_PREFIXES, BROWSE_URLS

ORDER_DAY, EVENT_DAY = "1998-06-16", "2024-01-16"


def _order_lines(table: str, code: str, item: str, amount: str, at: str, more: str = "", where: str = "") -> tuple[list[str], str]:
    return [table, "tb_order"], (
        f"SELECT CAST(o.user_id AS VARCHAR) AS user_id, {item} AS item_code, {amount} AS amount, {at} AS happened{more} "
        f"FROM {table} d LEFT JOIN tb_order o ON d.{code} = o.order_no WHERE o.user_id IS NOT NULL{where}"
    )


def _json(key: str) -> str:
    return f"CASE WHEN json_valid(param) THEN json_extract_string(param, '$.{key}') END"


def _views(subject: str) -> tuple[list[str], str]:
    urls = ", ".join(f"'{u}'" for u in BROWSE_URLS[subject])
    item = _json("parkingCode" if subject == "parking" else "code")
    return ["tbd_url_element"], (
        f"SELECT * FROM (SELECT {_json('userId')} AS user_id, {item} AS item_code, create_time AS happened "
        f"FROM tbd_url_element WHERE url IN ({urls})) WHERE user_id <> ''"
    )


def _coded(table: str, letter: str, where: str = "") -> tuple[list[str], str]:
    return [table], (
        f"SELECT CAST(user_id AS VARCHAR) AS user_id, code AS item_code, create_time AS happened FROM {table} "
        f"WHERE user_id IS NOT NULL AND code LIKE '{letter}%'{where}"
    )


_BANNER_CASE = "CASE " + " ".join(
    f"WHEN starts_with(url, '{p}') THEN '{b}'" for b, p in BANNER_URL_PREFIXES.items()) + " END"
_AMOUNT = " AND o.actual_amount IS NOT NULL"

# Events of each kind: source tables, and a query for user_id, item_code, at and what is measured.
EVENTS = {
    "rest_lines": _order_lines("restaurant_order_detail2", "fd_code", "d.fd_restaurant_code", "d.xfprice", "d.ordertime"),
    "rest_class": (["restaurant_order_detail2", "tb_order", "restaurant_class"],
                   "SELECT CAST(o.user_id AS VARCHAR) AS user_id, TRY_CAST(c.fd_cls AS DOUBLE) AS cls "
                   "FROM restaurant_order_detail2 d LEFT JOIN tb_order o ON d.fd_code = o.order_no "
                   "LEFT JOIN restaurant_class c ON d.fd_class = c.fd_class WHERE o.user_id IS NOT NULL"),
    "rest_uses": _order_lines("td_restaurant_order", "fd_code", "d.fd_restaurant_code", "NULL", "d.fd_date"),
    "parking": _order_lines("tb_order_parking", "order_no", "d.parking_code", "o.actual_amount", "d.create_date",
                            where=" AND d.parking_code IS NOT NULL" + _AMOUNT),
    "cip": _order_lines("tb_order_cip", "order_no", "d.pro_code", "o.actual_amount", "o.cdate",
                        where=" AND d.pro_code IS NOT NULL" + _AMOUNT),
    "vvip": _order_lines("tb_order_vvip", "order_no", "NULL", "o.actual_amount", "o.cdate", where=_AMOUNT),
    "car": _order_lines("tb_order_limousine", "order_no", "NULL", "o.actual_amount", "o.cdate", where=_AMOUNT),
    "cip_uses": (["tb_order_cip_record", "tb_order_cip", "tb_order"],
                 "SELECT CAST(p.user_id AS VARCHAR) AS user_id, p.pro_code AS item_code, r.create_time AS happened "
                 "FROM tb_order_cip_record r LEFT JOIN "
                 "(SELECT c.order_no, c.pro_code, o.user_id FROM tb_order_cip c LEFT JOIN tb_order o ON c.order_no = o.order_no) p "
                 "ON r.order_no = p.order_no WHERE p.user_id IS NOT NULL AND p.pro_code IS NOT NULL"),
    "lounge_visits": (["tblconsumerecord", "tb_bindrecord"],
                      "SELECT CAST(b.user_id AS VARCHAR) AS user_id, d.loungecode AS item_code, d.point AS amount, "
                      "d.personcount AS people, d.consumetime AS happened "
                      "FROM tblconsumerecord d LEFT JOIN tb_bindrecord b ON d.dragoncode = b.dragoncode "
                      "WHERE b.user_id IS NOT NULL AND d.loungecode IS NOT NULL"),
    "lounge_services": (["tb_order_loungeserv", "tb_bindrecord"],
                        "SELECT CAST(b.user_id AS VARCHAR) AS user_id, d.create_date AS happened, "
                        "unnest(string_split(regexp_replace(d.lounge_code, ',+$', ''), ',')) AS item_code "
                        "FROM tb_order_loungeserv d LEFT JOIN tb_bindrecord b ON d.dragoncode = b.dragoncode "
                        "WHERE b.user_id IS NOT NULL AND d.lounge_code IS NOT NULL"),
    **{f"{s}_views": _views(s) for s in BROWSE_URLS},
    "rest_collects": _coded("tb_user_collect", "R"), "lounge_collects": _coded("tb_user_collect", "N"),
    "shop_collects": _coded("tb_user_collect", "F"), "vvip_collects": _coded("tb_user_collect", "M"),
    "rest_comments": _coded("customer_share", "R"),
    "lounge_comments": _coded("tb_customer_share", "N", " AND score > 2"),
    "articles": (["tbd_visit_url"],
                 "SELECT user_id, split_part(split_part(url, '/', 5), '?', 1) AS item_code, create_time AS happened "
                 f"FROM tbd_visit_url WHERE user_id IS NOT NULL AND starts_with(url, '{ARTICLE_URL_PREFIX}')"),
    "banners": (["tbd_visit_url"],
                f"SELECT * FROM (SELECT user_id, {_BANNER_CASE} AS item_code, create_time AS happened FROM tbd_visit_url) "
                "WHERE user_id IS NOT NULL AND item_code IS NOT NULL"),
    "favors": (["tbd_lettres_favor"],
               "SELECT user_id, lettres_id AS item_code, create_time AS happened FROM tbd_lettres_favor "
               "WHERE user_id IS NOT NULL AND lettres_id IS NOT NULL"),
}

_EXACT = "CAST(sum(CAST({0} AS DECIMAL(28,8))) AS DOUBLE) / count({0})"
COUNT, REPEAT, MEAN, PEOPLE = "count(*)", "count(*) > 1", _EXACT.format("amount"), "CAST(sum(people) AS BIGINT)"
PRICED, NAMED, N_CODE = "amount IS NOT NULL", "item_code <> ''", "item_code LIKE 'N%'"
PREFERENCE = "CASE WHEN avg(cls) >= 0.5 THEN '中餐' ELSE '西餐' END"

# Job -> events, measure, field, extra condition. The level follows from the job's letter.
JOBS = {
    "A01": ("rest_lines", MEAN, "averageOrderAmount", PRICED),
    "A02": ("rest_lines", COUNT, "consumptionNum", None),
    "A03": ("rest_lines", REPEAT, "multitimeConsumption", None),
    "A04": ("rest_uses", COUNT, "usageCounter", None),
    "A05": ("rest_views", COUNT, "browseNum", NAMED),
    "A06": ("rest_collects", COUNT, "collectionNum", None),
    "A07": ("rest_comments", COUNT, "commentNum", None),
    "A08": ("parking", MEAN, "averageOrderAmount", None),
    "A09": ("parking_views", COUNT, "browseNum", NAMED),
    "A10": ("parking", COUNT, "consumptionNum", None),
    "A11": ("cip", f"{MEAN} AS averageOrderAmount, count(*)", "consumptionNum", None),
    "A12": ("cip_uses", COUNT, "usageCounter", None),
    "A13": ("lounge_visits", MEAN, "averageOrderAmount", PRICED),
    "A14": ("lounge_services", COUNT, "consumptionNum", None),
    "A15": ("lounge_visits", PEOPLE, "peopleConsumption", N_CODE),
    "A16": ("lounge_views", COUNT, "browseNum", NAMED),
    "A17": ("lounge_collects", COUNT, "collectionNum", None),
    "A18": ("lounge_comments", COUNT, "commentNum", None),
    "A19": ("lounge_visits", COUNT, "usageCounter", None),
    "A20": ("articles", COUNT, "browseNum", NAMED),
    "A21": ("favors", COUNT, "favorNum", None),
    "A22": ("shop_views", COUNT, "browseNum", NAMED),
    "A23": ("shop_collects", COUNT, "collectionNum", None),
    "A24": ("vvip_collects", COUNT, "collectionNum", None),
    "A25": ("banners", COUNT, "browseNum", None),
    "B02": ("shop_views", COUNT, "shopBrowseNum", None),
    "B03": ("shop_collects", COUNT, "shopCollectionNum", None),
    "B04": ("rest_lines", MEAN, "restAverageOrderAmount", PRICED),
    "B05": ("rest_lines", COUNT, "restConsumptionNum", None),
    "B06": ("rest_lines", REPEAT, "restMultitimeConsumption", None),
    "B07": ("rest_uses", COUNT, "restUsageCounter", None),
    "B08": ("rest_views", COUNT, "restBrowseNum", None),
    "B09": ("rest_collects", COUNT, "restCollectionNum", None),
    "B10": ("rest_comments", COUNT, "restCommentNum", None),
    "B11": ("cip", MEAN, "CIPAverageOrderAmount", None),
    "B12": ("cip_views", COUNT, "CIPBrowseNum", None),
    "B13": ("cip", COUNT, "CIPConsumptionNum", None),
    "B14": ("cip_uses", COUNT, "CIPUsageCounter", None),
    "B15": ("parking", MEAN, "parkingAverageOrderAmount", None),
    "B16": ("parking_views", COUNT, "parkingBrowseNum", None),
    "B17": ("parking", COUNT, "parkingConsumptionNum", None),
    "B18": ("lounge_visits", MEAN, "loungeAverageOrderAmount", PRICED),
    "B19": ("lounge_views", COUNT, "loungeBrowseNum", None),
    "B20": ("lounge_collects", COUNT, "loungeCollectionNum", None),
    "B21": ("lounge_comments", COUNT, "loungeCommentNum", None),
    "B22": ("lounge_services", COUNT, "loungeConsumptionNum", None),
    "B23": ("lounge_visits", PEOPLE, "loungePeopleConsumption", N_CODE),
    "B24": ("lounge_visits", COUNT, "loungeUsageCounter", None),
    "B25": ("rest_class", PREFERENCE, "restaurantPreferences", "cls IS NOT NULL"),
    "B26": ("vvip", MEAN, "VVIPAverageOrderAmount", None),
    "B27": ("vvip_views", COUNT, "VVIPBrowseNum", None),
    "B28": ("vvip_collects", COUNT, "VVIPCollectionNum", None),
    "B29": ("vvip", COUNT, "VVIPConsumptionNum", None),
    "B30": ("articles", COUNT, "articleBrowseNum", None),
    "B31": ("favors", COUNT, "articleFavorNum", None),
    "B32": ("banners", COUNT, "bannerBrowseNum", None),
    "B33": ("car", MEAN, "carAverageOrderAmount", None),
    "B34": ("car_views", COUNT, "carBrowseNum", None),
    "B35": ("car", COUNT, "carConsumptionNum", None),
}

_LABEL_SUMS = ", ".join(
    f"CAST(sum(CASE WHEN contains(labels, '{text}') THEN 1 ELSE 0 END) AS BIGINT) AS {field}"
    for field, text in ARTICLE_LABELS.items())
_LABEL_JOB = (
    "SELECT user_id AS id, user_id, {sums} FROM ("
    "SELECT v.user_id, CASE WHEN l.id IS NULL THEN '' ELSE l.person_labels END AS labels "
    "FROM ({visits}) v LEFT JOIN tbd_belles_lettres l ON v.item_code = l.id WHERE v.item_code <> '') "
    "WHERE labels IS NOT NULL GROUP BY user_id"
).format(sums=_LABEL_SUMS, visits=EVENTS["articles"][1])
_PRIORITY_JOB = (
    "SELECT fd_code AS id, fd_code AS item_code, CASE WHEN fd_isflashsale = 1 THEN 3 WHEN fd_iscoupon = 1 THEN 2 "
    "WHEN fd_settlementdiscount = 1 THEN 1 ELSE 0 END AS priority FROM itd_restaurant WHERE fd_lg = 'zh-cn'"
)


def _select(job: str, before: str | None = None) -> tuple[list[str], str]:
    sources, events = EVENTS[JOBS[job][0]]
    _, measure, field, extra = JOBS[job]
    keys = "user_id, item_code" if job.startswith("A") else "user_id"
    found = [c for c in (extra, f"happened < TIMESTAMP '{before} 00:00:00'" if before else None) if c]
    where = f" WHERE {' AND '.join(found)}" if found else ""
    doc_id = "user_id || item_code" if job.startswith("A") else "user_id"
    return sources, f"SELECT {doc_id} AS id, {keys}, {measure} AS {field} FROM ({events}){where} GROUP BY {keys}"


def job_sql(job: str) -> str:
    if job == "B01":
        return f"{with_sources('tbd_visit_url', 'tbd_belles_lettres')}\n{_LABEL_JOB}"
    if job == "A26":
        return f"{with_sources('itd_restaurant')}\n{_PRIORITY_JOB}"
    sources, sql = _select(job)
    return f"{with_sources(*sources)}\n{sql}"


def daily_sql(full_job: str) -> str:
    """Stored counts plus one day equal the count of everything before the day's end."""
    sources, sql = _select(full_job, before=day_of(full_job))
    return f"{with_sources(*sources)}\n{sql}"


def day_of(full_job: str) -> str:
    """As-of date with data on the day before: orders and events of the test tables lie years apart."""
    order_family = {"rest_lines", "rest_uses", "parking", "cip", "vvip", "car", "cip_uses", "lounge_visits", "lounge_services"}
    return ORDER_DAY if JOBS[full_job][0] in order_family else EVENT_DAY


def item_documents_sql(jobs: dict[str, str]) -> str:
    """``jobs``: job -> collection."""
    sources, parts = [], []
    for job, collection in jobs.items():
        used, sql = _select(job)
        sources += used
        parts.append(f"SELECT '{collection}' AS collection, * FROM ({sql})")
    fields = list(dict.fromkeys(["averageOrderAmount"] + [JOBS[j][2] for j in jobs]))
    fields_sql = ", ".join(f"max({f}) AS {f}" for f in fields)
    union = "\nUNION ALL BY NAME ".join(parts)
    return (f"{with_sources(*dict.fromkeys(sources))}\nSELECT collection, max(id) AS id, user_id, item_code, {fields_sql} "
            f"FROM ({union}) GROUP BY collection, user_id, item_code")


def user_documents_sql(jobs: list[str]) -> str:
    sources, parts, fields = ["tbd_visit_url", "tbd_belles_lettres"], [f"SELECT * FROM ({_LABEL_JOB})"], list(ARTICLE_LABELS)
    for job in jobs:
        used, sql = _select(job)
        sources += used
        parts.append(f"SELECT * FROM ({sql})")
        fields.append(JOBS[job][2])
    fields_sql = ", ".join(f"max({f}) AS {f}" for f in fields)
    union = "\nUNION ALL BY NAME ".join(parts)
    return (f"{with_sources(*dict.fromkeys(sources))}\nSELECT user_id AS id, user_id, {fields_sql} "
            f"FROM ({union}) GROUP BY user_id")


_LINES = "lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey"
_BY_USER_PART = f"FROM {_LINES} WHERE o.o_custkey IS NOT NULL GROUP BY o.o_custkey, l.l_partkey"
_USER_PART = "CAST(o.o_custkey AS VARCHAR) AS user_id, CAST(l.l_partkey AS VARCHAR) AS item_code"
_BY_USER = f"FROM {_LINES} WHERE o.o_custkey IS NOT NULL GROUP BY o.o_custkey"
_USER = "CAST(o.o_custkey AS VARCHAR) AS user_id"
PAGE_PREFIXES = {
    "blog": "https://blog.", "mobile": "https://m.", "plain_blog": "http://blog.", "plain_mobile": "http://m.",
}
# Prefixes of the table form: scheme and host, and with the first folder.
PAGE_TABLE = ("^[^:/]+://[^/]+", "^[^:/]+://[^/]+/[^/?]+")
_PAGE_CASE = "CASE " + " ".join(f"WHEN starts_with(url, '{p}') THEN '{b}'" for b, p in PAGE_PREFIXES.items()) + " END"
_LANGUAGE = "split_part(url, '/', 4)"

PATTERNS = {
    "p_count": f"SELECT {_USER_PART}, count(*) AS consumption_num {_BY_USER_PART}",
    "p_avg": f"SELECT {_USER_PART}, {_EXACT.format('l.l_extendedprice')} AS average_order_amount {_BY_USER_PART}",
    "p_avg_count": f"SELECT {_USER_PART}, {_EXACT.format('l.l_extendedprice')} AS average_order_amount, "
                   f"count(*) AS consumption_num {_BY_USER_PART}",
    "p_sum": f"SELECT {_USER}, CAST(sum(l.l_quantity) AS BIGINT) AS people_consumption FROM {_LINES} "
             "WHERE o.o_custkey IS NOT NULL AND l.l_returnflag LIKE 'N%' GROUP BY o.o_custkey",
    "p_flag": f"SELECT {_USER_PART}, count(*) > 1 AS multitime_consumption {_BY_USER_PART}",
    "p_intavg": f"SELECT {_USER}, CAST(trunc(sum(l.l_quantity)) AS BIGINT) // count(*) AS average_order_amount {_BY_USER}",
    "p_having": f"SELECT {_USER}, count(*) AS consumption_num {_BY_USER} HAVING count(*) <> 0",
    "p_count3": "SELECT CAST(p.c_custkey AS VARCHAR) AS user_id, count(*) AS usage_counter FROM lineitem l LEFT JOIN "
                "(SELECT o.o_orderkey, c.c_custkey FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey) p "
                "ON l.l_orderkey = p.o_orderkey WHERE p.c_custkey IS NOT NULL GROUP BY p.c_custkey",
    "p_cross": "SELECT CAST(p.o_custkey AS VARCHAR) AS user_id, p.o_orderpriority AS item_code, count(*) AS usage_counter "
               "FROM supplier s LEFT JOIN orders p ON p.o_orderkey = p.o_orderkey "
               "WHERE p.o_custkey IS NOT NULL AND p.o_orderpriority IS NOT NULL GROUP BY p.o_custkey, p.o_orderpriority",
    "p_browse": "SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS item_code, "
                "count(*) AS browse_num FROM events WHERE event_type IN ('view', 'click') AND user_id IS NOT NULL "
                "AND json_extract_string(props, '$.k') <> '' GROUP BY 1, 2",
    "p_prefix": "SELECT user_id, item_code, count(*) AS comment_num FROM (SELECT CAST(user_id AS VARCHAR) AS user_id, "
                "upper(substr(event_type, 1, 1)) || json_extract_string(props, '$.k') AS item_code, value FROM events) "
                "WHERE item_code LIKE 'P%' AND value > 2 GROUP BY 1, 2",
    "p_explode": "SELECT p_brand AS user_id, item_code, count(*) AS consumption_num FROM (SELECT p_brand, "
                 "unnest(string_split(regexp_replace(replace(p_name, ' ', ','), ',+$', ''), ',')) AS item_code FROM part) "
                 "GROUP BY 1, 2",
    "p_urlseg": f"SELECT {_LANGUAGE} AS user_id, split_part(split_part(url, '/', 5), '?', 1) AS item_code, "
                "count(*) AS browse_num FROM pages WHERE starts_with(url, 'https://') "
                "AND split_part(split_part(url, '/', 5), '?', 1) <> '' GROUP BY 1, 2",
    "p_banner": f"SELECT {_LANGUAGE} AS user_id, {_PAGE_CASE} AS item_code, count(*) AS browse_num FROM pages "
                f"WHERE {_PAGE_CASE} IS NOT NULL GROUP BY 1, 2",
    "p_anti": f"SELECT {_LANGUAGE} AS user_id, count(*) AS browse_num FROM pages WHERE {_PAGE_CASE} IS NULL GROUP BY 1",
    "p_labels": f"SELECT {_USER}, " + ", ".join(
        f"CAST(sum(CASE WHEN contains(coalesce(p.p_name, ''), '{w}') THEN 1 ELSE 0 END) AS BIGINT) AS {w}"
        for w in ("red", "small", "ring")) +
        f" FROM {_LINES} LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON l.l_partkey = p.p_partkey "
        "WHERE o.o_custkey IS NOT NULL GROUP BY o.o_custkey",
    "p_label_rows": "SELECT p_brand AS user_id, " + ", ".join(
        f"CAST(sum(CASE WHEN contains(p_name, '{w}') THEN 1 ELSE 0 END) AS BIGINT) AS {w}" for w in ("red", "small", "ring")) +
        " FROM part GROUP BY p_brand",
    "p_case": "SELECT CAST(p_partkey AS VARCHAR) AS item_code, CASE WHEN p_size % 7 = 0 THEN 3 WHEN p_size % 5 = 0 THEN 2 "
              "WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS priority FROM part WHERE p_type = 'ECONOMY'",
    "p_pref": f"SELECT {_USER}, CASE WHEN avg(CASE WHEN p.p_size >= 25 THEN 1.0 ELSE 0.0 END) >= 0.5 THEN 'large' "
              f"ELSE 'small' END AS preference FROM {_LINES} LEFT JOIN part p ON l.l_partkey = p.p_partkey "
              "WHERE o.o_custkey IS NOT NULL AND p.p_size IS NOT NULL GROUP BY o.o_custkey",
    "p_inc": "SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS item_code, count(*) AS browse_num FROM events "
             "WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1, 2",
    "p_merge": "SELECT user_id, max(orders_num) AS orders_num, max(events_num) AS events_num FROM ("
               "SELECT CAST(o_custkey AS VARCHAR) AS user_id, count(*) AS orders_num, NULL AS events_num FROM orders GROUP BY 1 "
               "UNION ALL SELECT CAST(user_id AS VARCHAR), NULL, count(*) FROM events GROUP BY 1) GROUP BY user_id",
    "p_merge_stored": "SELECT u.user_id, coalesce(e.last_seen, o.last_seen) AS last_seen, o.orders_num, e.events_num FROM "
                      "(SELECT CAST(o_custkey AS VARCHAR) AS user_id FROM orders UNION SELECT CAST(user_id AS VARCHAR) FROM events) u "
                      "LEFT JOIN (SELECT CAST(o_custkey AS VARCHAR) AS user_id, max(o_orderdate) AS last_seen, "
                      "count(*) AS orders_num FROM orders GROUP BY 1) o ON u.user_id = o.user_id "
                      "LEFT JOIN (SELECT CAST(user_id AS VARCHAR) AS user_id, max(ts) AS last_seen, "
                      "count(*) AS events_num FROM events GROUP BY 1) e ON u.user_id = e.user_id",
    "p_merge_day": "SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS item_code, max(ts) AS last_seen, "
                   "nullif(count(*) FILTER (ts < TIMESTAMP '2024-01-15 00:00:00'), 0) AS events_num, "
                   "nullif(count(*) FILTER (ts >= TIMESTAMP '2024-01-15 00:00:00'), 0) AS day_num "
                   "FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1, 2",
    "p_banner_table": "WITH p AS (SELECT DISTINCT unnest([" + ", ".join(f"regexp_extract(url, '{p}')" for p in PAGE_TABLE) + "]) AS prefix FROM pages), "
        "m AS (SELECT g.page_id, max_by(p.prefix, length(p.prefix)) AS item_code FROM pages g JOIN p ON p.prefix <> '' AND starts_with(g.url, p.prefix) GROUP BY 1) "
        "SELECT item_code, count(*) AS browse_num FROM m GROUP BY 1",
    "p_total": "SELECT count(*) AS events_num, count(DISTINCT user_id) AS users_num FROM events",
    "p_infer": "SELECT 'k:' || json_extract_string(props, '$.k') AS line FROM events",
    "rejected_page_views": with_sources("tbd_url_element") +
        f"\nSELECT url, count(*) AS rejected FROM (SELECT url, {_json('userId')} AS user_id FROM tbd_url_element "
        f"WHERE url IN ({', '.join(repr(u) for urls in BROWSE_URLS.values() for u in urls)})) "
        "WHERE user_id IS NULL OR user_id = '' GROUP BY url",
    "e02_table_counts": with_sources("tbd_app_opera_path", "tb_order", "tb_user") +
        "\nSELECT (SELECT count(*) FROM tbd_app_opera_path) AS operations_num, (SELECT count(*) FROM tb_order) AS orders_num, "
        "(SELECT count(DISTINCT id) FROM tb_user) AS users_num",
    "e01_document_query": with_sources("user_flight") +
        "\nSELECT 'userID:' || coalesce(json_extract_string(doc, '$.userId'), 'null') || '|isStop:' || "
        "coalesce(json_extract_string(doc, '$.isStop'), 'null') AS line FROM user_flight WHERE json_valid(doc)",
    "document_values": with_sources("user_flight") +
        "\nSELECT field, count(json_extract_string(doc, '$.' || field)) AS documents, count(DISTINCT json_extract_string(doc, '$.' || field)) AS values "
        "FROM user_flight CROSS JOIN (SELECT DISTINCT unnest(json_keys(doc)) AS field FROM user_flight) GROUP BY field",
    "document_files": "WITH d AS (SELECT event_id % 101 = 5 AS rejected, " + DOCUMENTS.columns["doc"] + " AS doc FROM events) "
        "SELECT CASE WHEN NOT rejected THEN json_extract_string(doc, '$.isStop') END AS \"isStop\", rejected, count(*) AS lines, "
        "count(CASE WHEN NOT rejected THEN json_extract_string(doc, '$.userId') END) AS users FROM d GROUP BY 1, 2",
    "other_visits": with_sources("tbd_visit_url") +
        "\nSELECT user_id, count(*) AS browse_num FROM tbd_visit_url "
        f"WHERE user_id IS NOT NULL AND url IS NOT NULL AND {_BANNER_CASE} IS NULL GROUP BY user_id",
}
PATTERNS["p_merge_documents"] = PATTERNS["p_merge_stored"]
