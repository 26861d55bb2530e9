"""The registered queries, on the package's operators."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from testbed import oracles
from testbed.oracles import PAGE_PREFIXES
from testbed.standins import DOCUMENTS, load, registry
from wayprint.functions import (
    any_prefix, document_id, explode_codes, has_prefix, in_values, json_field, label_flag, not_blank,
    prefix_id, present, priority_of, url_segment, day_window, in_window,
)
from wayprint.operators import (
    apply_increment, attach, count_by, distinct_total, integer_mean_by, label_sums_by,
    majority_label_by, mean_and_count_by, mean_by, merge_fields, merge_into, paired_count_by, prefix_lookup,
    repeat_flag_by, sum_by, total,
)
from wayprint.plans.catalog import DAILY_JOBS, FULL_JOBS, ITEM_JOBS, USER_JOBS
from wayprint.plans.facts import LABEL_PARTS, PARTS, Window, other_visits, rejected_page_views
from wayprint.plans.jobs import run_daily, run_job, table_counts
from wayprint.plans.profiles import ITEM_PARTS, build_state, fact_rows, item_documents, user_documents
from wayprint.plans.store import DocumentStore, scratch_root
from wayprint.sources import (
    document_values as values_of_documents, documents_table, format_row, query_documents, read_documents, variant_documents,
)
from wayprint.sources.documents import REJECTED

Query = Callable[[SparkSession, str], DataFrame]
USER_ITEM = ["user_id", "item_code"]


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with the user of their order."""
    lines = load("lineitem", spark, sf).withColumn("item_code", F.col("l_partkey"))
    orders = load("orders", spark, sf).select("o_orderkey", F.col("o_custkey").alias("user_id"))
    return attach(lines, orders, {"l_orderkey": "o_orderkey"}, require=["user_id"])


def text_keys(df: DataFrame) -> DataFrame:
    """Key columns as text, once per group and not per row."""
    return df.withColumns({k: F.col(k).cast("string") for k in USER_ITEM if k in df.columns})


def p_count(spark, sf):
    return text_keys(count_by(order_lines(spark, sf), USER_ITEM, "consumption_num"))


def p_avg(spark, sf):
    return text_keys(mean_by(order_lines(spark, sf), USER_ITEM, "l_extendedprice", "average_order_amount"))


def p_avg_count(spark, sf):
    return text_keys(mean_and_count_by(order_lines(spark, sf), USER_ITEM, "l_extendedprice", "average_order_amount", "consumption_num"))


def p_sum(spark, sf):
    lines = order_lines(spark, sf).filter(has_prefix("l_returnflag", "N"))
    people = lines.withColumn("people", F.col("l_quantity").cast("bigint"))
    return text_keys(sum_by(people, ["user_id"], "people", "people_consumption"))


def p_flag(spark, sf):
    return text_keys(repeat_flag_by(order_lines(spark, sf), USER_ITEM, "multitime_consumption"))


def p_intavg(spark, sf):
    return text_keys(integer_mean_by(order_lines(spark, sf), ["user_id"], "l_quantity", "average_order_amount"))


def p_having(spark, sf):
    return text_keys(count_by(order_lines(spark, sf).dropna(subset=["user_id", "l_extendedprice"]), ["user_id"],
                    "consumption_num", having="consumption_num <> 0"))


def p_count3(spark, sf):
    customers = load("customer", spark, sf).select("c_custkey")
    orders = attach(load("orders", spark, sf), customers.withColumn("known", F.lit(True)), {"o_custkey": "c_custkey"})
    orders = orders.filter("known").withColumnRenamed("o_orderkey", "order_no").select("order_no", "o_custkey")
    lines = attach(load("lineitem", spark, sf), orders, {"l_orderkey": "order_no"}, require=["o_custkey"])
    return text_keys(count_by(lines.withColumnRenamed("o_custkey", "user_id"), ["user_id"], "usage_counter"))


def p_cross(spark, sf):
    orders = load("orders", spark, sf).select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("item_code"))
    return text_keys(paired_count_by(load("supplier", spark, sf), orders, USER_ITEM, "usage_counter"))


def p_browse(spark, sf):
    views = load("events", spark, sf).filter(in_values("event_type", ["view", "click"])).select(
        F.col("user_id").cast("string").alias("user_id"), json_field("props", "k").alias("item_code"))
    return count_by(views.filter(not_blank("user_id") & not_blank("item_code")), USER_ITEM, "browse_num")


def p_prefix(spark, sf):
    coded = load("events", spark, sf).filter("user_id is not null and value > 2").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.upper(F.substring("event_type", 1, 1)), json_field("props", "k")).alias("item_code"))
    return count_by(coded.filter(has_prefix("item_code", "P")), USER_ITEM, "comment_num")


def p_explode(spark, sf):
    parts = load("part", spark, sf).select(
        F.col("p_brand").alias("user_id"), F.translate("p_name", " ", ",").alias("codes"))
    return count_by(explode_codes(parts.filter(present("user_id", "codes")), "codes", "item_code"), USER_ITEM, "consumption_num")


def p_urlseg(spark, sf):
    pages = load("pages", spark, sf).filter(has_prefix("url", "https://")).select(
        url_segment("url", 3).alias("user_id"), url_segment("url", 4).alias("item_code"))
    return count_by(pages.filter(not_blank("item_code")), USER_ITEM, "browse_num")


def p_banner(spark, sf):
    pages = load("pages", spark, sf).filter(any_prefix("url", PAGE_PREFIXES.values())).select(
        url_segment("url", 3).alias("user_id"), prefix_id("url", PAGE_PREFIXES).alias("item_code"))
    return count_by(pages, USER_ITEM, "browse_num")


def p_banner_table(spark, sf):
    """As p_banner, with the prefixes as a table: every host of the pages, and every first folder."""
    pages = load("pages", spark, sf).select("url")
    prefixes = pages.select(F.explode(F.array(*[F.regexp_extract("url", p, 0) for p in oracles.PAGE_TABLE])).alias("prefix"))
    prefixes = prefixes.filter("prefix <> ''").distinct().withColumn("id", F.col("prefix"))
    found = prefix_lookup(pages, "url", prefixes, "item_code")
    return count_by(found.filter(present("item_code")), ["item_code"], "browse_num")


def p_anti(spark, sf):
    pages = load("pages", spark, sf).filter(~any_prefix("url", PAGE_PREFIXES.values()))
    return count_by(pages.select(url_segment("url", 3).alias("user_id")), ["user_id"], "browse_num")


def p_labels(spark, sf):
    per_part = count_by(order_lines(spark, sf), ["user_id", "l_partkey"], "n")
    large = load("part", spark, sf).filter("p_size > 10").select("p_partkey", "p_name")
    named = attach(per_part, large, {"l_partkey": "p_partkey"}).withColumn("p_name", F.coalesce("p_name", F.lit("")))
    words = ["red", "small", "ring"]
    return text_keys(named.groupBy("user_id").agg(*[F.sum(label_flag("p_name", w) * F.col("n")).alias(w) for w in words]))


def p_label_rows(spark, sf):
    parts = load("part", spark, sf).withColumn("user_id", F.col("p_brand"))
    return label_sums_by(parts, ["user_id"], "p_name", {"red": "red", "small": "small", "ring": "ring"})


def p_case(spark, sf):
    parts = load("part", spark, sf).filter(F.col("p_type") == "ECONOMY")
    flags = {f"by{n}": (F.col("p_size") % n == 0).cast("int") for n in (7, 5, 3)}
    return parts.withColumns(flags).select(
        F.col("p_partkey").cast("string").alias("item_code"),
        priority_of([("by7", 3), ("by5", 2), ("by3", 1)]).alias("priority"))


def p_pref(spark, sf):
    classes = load("part", spark, sf).select(
        "p_partkey", F.when(F.col("p_size") >= 25, "1").otherwise("0").alias("cls")).filter(present("p_partkey"))
    per_part = count_by(order_lines(spark, sf), ["user_id", "l_partkey"], "n")
    classed = attach(per_part, classes, {"l_partkey": "p_partkey"})
    return text_keys(majority_label_by(classed, ["user_id"], "cls", "preference", labels=("large", "small"), rows="n"))


def p_inc(spark, sf):
    events = load("events", spark, sf).select(
        F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("item_code"), "ts")
    as_of = dt.date(2024, 1, 16)
    stored = count_by(events.filter(in_window(events, "ts", end=as_of - dt.timedelta(days=1))), USER_ITEM, "browse_num")
    day = count_by(events.filter(day_window(events, "ts", as_of)), USER_ITEM, "browse_num")
    return apply_increment(stored, day, USER_ITEM)


def _per_user(spark, sf):
    orders = load("orders", spark, sf).select(F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderdate").alias("at"))
    events = load("events", spark, sf).select(F.col("user_id").cast("string").alias("user_id"), F.col("ts").alias("at"))
    return orders, events


def p_merge(spark, sf):
    orders, events = _per_user(spark, sf)
    return merge_fields(
        [count_by(orders, ["user_id"], "orders_num"), count_by(events, ["user_id"], "events_num")], ["user_id"])


def p_merge_stored(spark, sf):
    orders, events = _per_user(spark, sf)
    stored = orders.groupBy("user_id").agg(F.max("at").alias("last_seen"), F.count(F.lit(1)).alias("orders_num"))
    changes = events.groupBy("user_id").agg(F.max("at").alias("last_seen"), F.count(F.lit(1)).alias("events_num"))
    return merge_into(stored, changes, ["user_id"])


def _seen(rows: DataFrame, count: str) -> DataFrame:
    return rows.groupBy("user_id").agg(F.max("at").alias("last_seen"), F.count(F.lit(1)).alias(count))


def p_merge_documents(spark, sf):
    """A stored profile of users, and a version of it with another source's fields merged in."""
    orders, events = _per_user(spark, sf)
    store = DocumentStore(spark, scratch_root(spark), ["user_id"], buckets=8)
    store.merge(_seen(orders, "orders_num"))
    store.merge(_seen(events, "events_num"))
    return store.read()


def p_merge_day(spark, sf):
    """Stored documents of users and event types, and a version with one day's users merged in.

    Only the buckets of that day's keys are written anew: the manifest of the second
    version names the first one's folders for all others.
    """
    events = load("events", spark, sf).select(
        F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("item_code"), F.col("ts").alias("at"))
    as_of = dt.date(2024, 1, 16)
    before = events.filter(in_window(events, "at", end=as_of - dt.timedelta(days=1)))
    day = events.filter(day_window(events, "at", as_of))
    store = DocumentStore(spark, scratch_root(spark), USER_ITEM, buckets=256)
    store.merge(before.groupBy(*USER_ITEM).agg(F.max("at").alias("last_seen"), F.count(F.lit(1)).alias("events_num")))
    store.merge(day.groupBy(*USER_ITEM).agg(F.max("at").alias("last_seen"), F.count(F.lit(1)).alias("day_num")))
    return store.read()


def p_total(spark, sf):
    events = load("events", spark, sf)
    return total(events, "events_num").withColumn(
        "users_num", distinct_total(events, "user_id", "users_num").scalar())


def p_infer(spark, sf):
    """Documents by whatever fields they turn out to have: one scan, no schema beforehand."""
    documents = variant_documents(load("events", spark, sf), "props")
    found = query_documents(documents, "SELECT try_variant_get(doc, '$.k', 'string') AS k FROM {documents}")
    return found.select(format_row(k="k").alias("line"))


def e01_document_query(spark, sf):
    stored = load(DOCUMENTS.base, spark, sf).selectExpr(f"{DOCUMENTS.columns['doc']} AS doc")
    users = query_documents(documents_table(stored, "doc", ["userId", "isStop"]), "select userId, isStop from {documents}")
    return users.select(format_row(userID="userId", isStop="isStop").alias("line"))


def document_values(spark, sf):
    """Values of every field that any document has, whichever document comes first."""
    stored = load(DOCUMENTS.base, spark, sf).selectExpr(f"{DOCUMENTS.columns['doc']} AS doc")
    return values_of_documents(stored, "doc").groupBy("field").agg(
        F.count("value").alias("documents"), F.count_distinct("value").alias("values"))


def document_files(spark, sf):
    """Documents written as JSON lines, some of them broken, and read back; broken ones are counted."""
    path = f"{scratch_root(spark)}/documents"
    stored = load(DOCUMENTS.base, spark, sf)
    stored.selectExpr(f"CASE WHEN event_id % 101 = 5 THEN concat('{{', event_type) ELSE {DOCUMENTS.columns['doc']} END AS value").write.text(path)
    read = read_documents(spark, path, ["userId", "isStop"])
    return read.withColumn("rejected", F.col(REJECTED).isNotNull()).groupBy("isStop", "rejected").agg(
        F.count(F.lit(1)).alias("lines"), F.count("userId").alias("users"))


def e02_table_counts(spark, sf):
    return table_counts(registry(spark, sf))


def item_profiles(spark, sf):
    return item_documents(build_state(registry(spark, sf), parts=ITEM_PARTS))


def user_profiles(spark, sf):
    return user_documents(fact_rows(registry(spark, sf), parts=[*PARTS, *LABEL_PARTS], items=False))


PATTERNS: dict[str, Query] = {
    f.__name__: f for f in (
        p_count, p_avg, p_avg_count, p_sum, p_flag, p_intavg, p_having, p_count3, p_cross, p_browse, p_prefix,
        p_explode, p_urlseg, p_banner, p_banner_table, p_anti, p_labels, p_label_rows, p_case, p_pref, p_inc, p_merge,
        p_merge_stored, p_merge_documents, p_merge_day, p_total, p_infer,
    )
}


def _job(job: str) -> Query:
    return lambda spark, sf: run_job(registry(spark, sf), job)


def _daily(job: str) -> Query:
    full = DAILY_JOBS[job]
    as_of = dt.date.fromisoformat(oracles.day_of(full))

    def query(spark: SparkSession, sf: str) -> DataFrame:
        tables = registry(spark, sf)
        stored = run_job(tables, full, Window(end=as_of - dt.timedelta(days=1)))
        return run_daily(tables, job, as_of, stored)

    return query


def _name(job: str, daily: bool = False) -> str:
    full = FULL_JOBS[DAILY_JOBS[job] if daily else job]
    if full.level == "labels":
        words = "article_labels"
    else:
        words = "_".join(re.sub(r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", f).lower() for f in full.fields)
    if full.level == "item":
        words = f"{full.subject}_{words}"
    return f"{job.lower()}_{'daily_' if daily else ''}{words}"


def all_queries() -> dict[str, Query]:
    found = dict(PATTERNS)
    found.update({_name(j): _job(j) for j in FULL_JOBS})
    found.update({_name(j, True): _daily(j) for j in DAILY_JOBS})
    found.update({q.__name__: q for q in (e01_document_query, e02_table_counts, document_values, document_files)})
    found["item_profiles"] = item_profiles
    found["user_profiles"] = user_profiles
    found["rejected_page_views"] = lambda spark, sf: rejected_page_views(registry(spark, sf))
    found["other_visits"] = lambda spark, sf: count_by(other_visits(registry(spark, sf)), ["user_id"], "browse_num")
    return found


def all_oracles() -> dict[str, str]:
    found = dict(oracles.PATTERNS)
    found.update({_name(j): oracles.job_sql(j) for j in FULL_JOBS})
    found.update({_name(j, True): oracles.daily_sql(DAILY_JOBS[j]) for j in DAILY_JOBS})
    found["item_profiles"] = oracles.item_documents_sql({j.id: j.collection for j in ITEM_JOBS})
    found["user_profiles"] = oracles.user_documents_sql([j.id for j in USER_JOBS])
    return found
