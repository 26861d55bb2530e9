"""All profiles at once: one additive state, from which every document follows.

The state has a row per subject, user and item with the summed parts of all
facts. Each source is scanned once, whatever the number of metrics, and a day is
added by summing. Means, flags and preferences are not additive themselves; they
are taken from the parts when documents are made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wayprint.functions import any_present, document_id, in_values
from wayprint.operators import attach
from wayprint.plans.catalog import ITEM_JOBS, USER_JOBS, Value
from wayprint.plans.facts import FACTS, KEYS, LABEL_PARTS, PARTS, Window, no_part, sum_parts
from wayprint.plans.jobs import article_label_sums
from wayprint.sources import Registry


def fact_rows(
    registry: Registry, window: Window = Window(), facts: Iterable[str] | None = None, parts: Iterable[str] | None = None,
    items: bool = True,
) -> DataFrame:
    """The rows of all facts together, not summed. Of sources, only what ``parts`` need is read.

    With ``LABEL_PARTS`` among them, views carry the labels of their articles. User documents
    need no ``items``; without them orders and lounge visits are summed before their joins.
    """
    return _together([FACTS[n].rows(registry, window, parts=parts, items=items) for n in (FACTS if facts is None else facts)])


def build_state(
    registry: Registry, window: Window = Window(), facts: Iterable[str] | None = None, parts: Iterable[str] | None = None,
) -> DataFrame:
    """The state of a span of days: all facts summed in one aggregation."""
    return sum_parts(fact_rows(registry, window, facts, parts), KEYS)


# What item documents are made of.
ITEM_PARTS = sorted({part for job in ITEM_JOBS for part in job.parts})


def add_states(*states: DataFrame) -> DataFrame:
    """The state of all the days of the given states together."""
    return sum_parts(_together(states), KEYS)


def _together(rows: Iterable[DataFrame]) -> DataFrame:
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    labels = [p for p in LABEL_PARTS if p in union.columns]
    return union.select(*KEYS, *[p if p in union.columns else no_part(p) for p in PARTS], *labels)


def item_documents(state: DataFrame) -> DataFrame:
    """One document per collection, user and item, with the fields of all item jobs.

    A field its collection does not have is null.
    """
    fields = {
        field: F.when(in_values("subject", subjects), value.column())
        for (field, value), subjects in _subjects_by_field().items()
    }
    documents = state.filter("itemized").select(
        F.concat(F.lit("user"), "subject").alias("collection"), document_id("user_id", "item_code").alias("id"),
        "user_id", "item_code", *[c.alias(f) for f, c in fields.items()],
    )
    return documents.filter(any_present(*fields))


def user_documents(state: DataFrame, registry: Registry | None = None) -> DataFrame:
    """One document per user with the fields of all user jobs.

    ``state`` may also be unsummed fact rows, when no item documents are wanted. Sums of
    article labels are taken from its label parts where it has them. A stored state has
    none, because articles may be relabelled; with a registry the sums are then made
    from its article rows and the labels of today.
    """
    per_subject = sum_parts(state, ["user_id", "subject"])
    wanted = {(job.subject, part) for job in USER_JOBS for part in job.parts}
    labels = [p for p in LABEL_PARTS if p in state.columns]
    summed = per_subject.groupBy("user_id").agg(
        *[F.max(F.when(F.col("subject") == subject, F.col(part))).alias(f"{subject}_{part}") for subject, part in sorted(wanted)],
        *[F.max(part).alias(part) for part in labels])
    fields = {
        field: value.column(_named(job.subject))
        for job in USER_JOBS for field, value in job.fields.items()
    }
    fields |= {part.removeprefix("label_"): F.col(part) for part in labels}
    documents = summed.select(
        document_id("user_id").alias("id"), "user_id", *[c.alias(f) for f, c in fields.items()],
    )
    names = list(fields)
    if registry is not None and not labels:
        found = article_label_sums(state.filter("subject = 'article' and itemized and browse_n is not null"), registry)
        documents = attach(documents, found, {"user_id": "user_id"})
        names += [c for c in found.columns if c != "user_id"]
    return documents.filter(any_present(*names))


def _subjects_by_field() -> dict[tuple[str, Value], list[str]]:
    found: dict[tuple[str, Value], list[str]] = {}
    for job in ITEM_JOBS:
        for field, value in job.fields.items():
            found.setdefault((field, value), []).append(job.subject)
    return found


def _named(subject: str) -> Callable[[str], Column]:
    return lambda part: F.col(f"{subject}_{part}")
