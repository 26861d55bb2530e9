"""Runs jobs one at a time, for a full history or for one day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from wayprint.constants import ARTICLE_LABELS, PRIORITY_FLAGS, RESTAURANT_LANGUAGE
from wayprint.functions import any_present, document_id, label_flag, present, priority_of
from wayprint.operators import apply_increment, attach, distinct_total, total
from wayprint.plans.catalog import DAILY_JOBS, FULL_JOBS, Job
from wayprint.plans.facts import FACTS, Window, sum_parts
from wayprint.sources import Registry


def run_job(registry: Registry, job_id: str, window: Window = Window()) -> DataFrame:
    """The documents of one full-history job: ``id``, the keys, the fields."""
    job = FULL_JOBS[job_id]
    if job.level == "restaurant":
        return restaurant_priorities(registry)
    if job.level == "labels":
        rows = _job_rows(registry, job, ["browse_n"], window).filter("itemized")
        found = article_label_sums(sum_parts(rows, ["user_id", "item_code"]), registry)
        return found.select(document_id("user_id").alias("id"), "user_id", *job.fields)
    return _with_id(_values(registry, job, window), job)


def run_daily(registry: Registry, job_id: str, as_of: dt.date, stored: DataFrame) -> DataFrame:
    """Stored documents of a daily job with the day before ``as_of`` added.

    ``stored`` has the job's keys and its count. The result depends on the
    stored documents and the day only, so running a day again from the same
    stored documents gives the same result.
    """
    job = FULL_JOBS[DAILY_JOBS[job_id]]
    day = _values(registry, job, Window.day_before(as_of))
    return _with_id(apply_increment(stored.select(*job.keys, *job.fields), day, job.keys), job)


def restaurant_priorities(registry: Registry) -> DataFrame:
    """Priority of each restaurant in the chosen language; a row per source row."""
    return (
        registry.table("itd_restaurant").filter(F.col("fd_lg") == RESTAURANT_LANGUAGE)
        .select(F.col("fd_code").alias("id"), F.col("fd_code").alias("item_code"),
                priority_of(PRIORITY_FLAGS).alias("priority"))
    )


def table_counts(registry: Registry) -> DataFrame:
    """Rows of the operation log and of the orders, and the number of users."""
    operations = total(registry.table("tbd_app_opera_path"), "operations_num")
    orders = total(registry.table("tb_order"), "orders_num").scalar()
    users = distinct_total(registry.table("tb_user"), "id", "users_num").scalar()
    return operations.select("operations_num", orders.alias("orders_num"), users.alias("users_num"))


def article_label_sums(browsed: DataFrame, registry: Registry) -> DataFrame:
    """Per user, how many article views carried each label.

    ``browsed`` holds view counts per user and article, so a popular article
    enters the join once per user and not once per view. An article without a
    row counts as having no labels; one whose labels are null is left out.
    """
    labels = registry.table("tbd_belles_lettres").withColumn("known", F.lit(True))
    views = attach(browsed.select("user_id", "item_code", "browse_n"), labels, {"item_code": "id"})
    views = views.withColumn(
        "person_labels", F.when(F.col("known").isNull(), F.lit("")).otherwise(F.col("person_labels")),
    ).filter(present("person_labels"))
    return views.groupBy("user_id").agg(*[
        F.sum(label_flag("person_labels", text) * F.col("browse_n")).alias(field)
        for field, text in ARTICLE_LABELS.items()
    ])


def _job_rows(registry: Registry, job: Job, parts: list[str], window: Window) -> DataFrame:
    return FACTS[job.fact].rows(registry, window, [job.subject], parts, items=job.level != "user")


def _values(registry: Registry, job: Job, window: Window) -> DataFrame:
    rows = _job_rows(registry, job, job.parts, window)
    if job.level == "item":
        rows = rows.filter("itemized")
    rows = rows.filter(any_present(*job.parts))
    values = sum_parts(rows, job.keys).select(*job.keys, *[v.column().alias(f) for f, v in job.fields.items()])
    return values.filter(any_present(*job.fields))


def _with_id(values: DataFrame, job: Job) -> DataFrame:
    return values.select(document_id(*job.keys).alias("id"), *values.columns)
