"""The 103 metric jobs as data.

A job names the fact it reads, the subject, the level of its documents and, per
output field, a value over the parts of the fact. Daily jobs repeat a
full-history job for one day; see :mod:`wayprint.plans.jobs`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from wayprint.constants import ARTICLE_LABELS, PREFERENCE_LABELS, PREFERENCE_THRESHOLD, REPEAT_ABOVE
from wayprint.functions import limbs_of, mean_of, reaches


@dataclass(frozen=True)
class Value:
    """A field computed from parts. ``of`` takes the columns in the order of ``parts``."""

    parts: tuple[str, ...]
    of: Callable[..., Column]

    def column(self, get: Callable[[str], Column] = F.col) -> Column:
        return self.of(*[get(p) for p in self.parts])


def added(part: str) -> Value:
    """A count or sum."""
    return Value((part,), lambda total: total)


MEAN_AMOUNT = Value((*limbs_of("amount"), "amount_n"), mean_of)
REPEATS = Value(("order_n",), lambda n: n > REPEAT_ABOVE)
PREFERENCE = Value(
    (*limbs_of("class"), "class_n"),
    lambda whole, high, low, n: F.when(n.isNotNull(), F.when(
        reaches(whole, high, low, n, PREFERENCE_THRESHOLD), PREFERENCE_LABELS[0]).otherwise(PREFERENCE_LABELS[1])),
)
ORDERS, USES, BROWSES = added("order_n"), added("usage_n"), added("browse_n")
COLLECTIONS, COMMENTS, PEOPLE, FAVORS = added("collection_n"), added("comment_n"), added("people_sum"), added("favor_n")


@dataclass(frozen=True)
class Job:
    id: str
    collection: str
    level: str                       # "item", "user", "labels" or "restaurant"
    fact: str
    subject: str
    fields: dict[str, Value]

    @property
    def keys(self) -> list[str]:
        return ["user_id", "item_code"] if self.level == "item" else ["user_id"]

    @property
    def parts(self) -> list[str]:
        return list(dict.fromkeys(p for v in self.fields.values() for p in v.parts))


def _item(id: str, subject: str, fact: str, **fields: Value) -> Job:
    return Job(id, f"user{subject}", "item", fact, subject, fields)


def _user(id: str, subject: str, fact: str, **fields: Value) -> Job:
    return Job(id, "usertags", "user", fact, subject, fields)


# Full history, one document per user and item.
ITEM_JOBS = [
    _item("A01", "rest", "orders", averageOrderAmount=MEAN_AMOUNT),
    _item("A02", "rest", "orders", consumptionNum=ORDERS),
    _item("A03", "rest", "orders", multitimeConsumption=REPEATS),
    _item("A04", "rest", "orders", usageCounter=USES),
    _item("A05", "rest", "browses", browseNum=BROWSES),
    _item("A06", "rest", "collections", collectionNum=COLLECTIONS),
    _item("A07", "rest", "comments", commentNum=COMMENTS),
    _item("A08", "parking", "orders", averageOrderAmount=MEAN_AMOUNT),
    _item("A09", "parking", "browses", browseNum=BROWSES),
    _item("A10", "parking", "orders", consumptionNum=ORDERS),
    _item("A11", "cip", "orders", averageOrderAmount=MEAN_AMOUNT, consumptionNum=ORDERS),
    _item("A12", "cip", "orders", usageCounter=USES),
    _item("A13", "lounge", "lounges", averageOrderAmount=MEAN_AMOUNT),
    _item("A14", "lounge", "lounges", consumptionNum=ORDERS),
    _item("A15", "lounge", "lounges", peopleConsumption=PEOPLE),
    _item("A16", "lounge", "browses", browseNum=BROWSES),
    _item("A17", "lounge", "collections", collectionNum=COLLECTIONS),
    _item("A18", "lounge", "comments", commentNum=COMMENTS),
    _item("A19", "lounge", "lounges", usageCounter=USES),
    _item("A20", "article", "visits", browseNum=BROWSES),
    _item("A21", "article", "favors", favorNum=FAVORS),
    _item("A22", "shop", "browses", browseNum=BROWSES),
    _item("A23", "shop", "collections", collectionNum=COLLECTIONS),
    _item("A24", "vvip", "collections", collectionNum=COLLECTIONS),
    _item("A25", "banner", "visits", browseNum=BROWSES),
]

# One row per restaurant, straight from its flags.
PRIORITY_JOB = Job("A26", "restaurant", "restaurant", "", "", {"priority": Value((), lambda: F.col("priority"))})

# Full history, one document per user: article labels, then sums over all items.
LABEL_JOB = Job("B01", "usertags", "labels", "visits", "article", {f: Value((), lambda: F.col(f)) for f in ARTICLE_LABELS})
USER_JOBS = [
    _user("B02", "shop", "browses", shopBrowseNum=BROWSES),
    _user("B03", "shop", "collections", shopCollectionNum=COLLECTIONS),
    _user("B04", "rest", "orders", restAverageOrderAmount=MEAN_AMOUNT),
    _user("B05", "rest", "orders", restConsumptionNum=ORDERS),
    _user("B06", "rest", "orders", restMultitimeConsumption=REPEATS),
    _user("B07", "rest", "orders", restUsageCounter=USES),
    _user("B08", "rest", "browses", restBrowseNum=BROWSES),
    _user("B09", "rest", "collections", restCollectionNum=COLLECTIONS),
    _user("B10", "rest", "comments", restCommentNum=COMMENTS),
    _user("B11", "cip", "orders", CIPAverageOrderAmount=MEAN_AMOUNT),
    _user("B12", "cip", "browses", CIPBrowseNum=BROWSES),
    _user("B13", "cip", "orders", CIPConsumptionNum=ORDERS),
    _user("B14", "cip", "orders", CIPUsageCounter=USES),
    _user("B15", "parking", "orders", parkingAverageOrderAmount=MEAN_AMOUNT),
    _user("B16", "parking", "browses", parkingBrowseNum=BROWSES),
    _user("B17", "parking", "orders", parkingConsumptionNum=ORDERS),
    _user("B18", "lounge", "lounges", loungeAverageOrderAmount=MEAN_AMOUNT),
    _user("B19", "lounge", "browses", loungeBrowseNum=BROWSES),
    _user("B20", "lounge", "collections", loungeCollectionNum=COLLECTIONS),
    _user("B21", "lounge", "comments", loungeCommentNum=COMMENTS),
    _user("B22", "lounge", "lounges", loungeConsumptionNum=ORDERS),
    _user("B23", "lounge", "lounges", loungePeopleConsumption=PEOPLE),
    _user("B24", "lounge", "lounges", loungeUsageCounter=USES),
    _user("B25", "rest", "orders", restaurantPreferences=PREFERENCE),
    _user("B26", "vvip", "orders", VVIPAverageOrderAmount=MEAN_AMOUNT),
    _user("B27", "vvip", "browses", VVIPBrowseNum=BROWSES),
    _user("B28", "vvip", "collections", VVIPCollectionNum=COLLECTIONS),
    _user("B29", "vvip", "orders", VVIPConsumptionNum=ORDERS),
    _user("B30", "article", "visits", articleBrowseNum=BROWSES),
    _user("B31", "article", "favors", articleFavorNum=FAVORS),
    _user("B32", "banner", "visits", bannerBrowseNum=BROWSES),
    _user("B33", "car", "orders", carAverageOrderAmount=MEAN_AMOUNT),
    _user("B34", "car", "browses", carBrowseNum=BROWSES),
    _user("B35", "car", "orders", carConsumptionNum=ORDERS),
]

FULL_JOBS = {job.id: job for job in [*ITEM_JOBS, PRIORITY_JOB, LABEL_JOB, *USER_JOBS]}

# Daily increment -> the full-history job whose counts it carries forward.
DAILY_JOBS = {
    "C01": "A02", "C02": "A04", "C03": "A05", "C04": "A06", "C05": "A07", "C06": "A14",
    "C07": "A17", "C08": "A18", "C09": "A19", "C10": "A24", "C11": "A09", "C12": "A10",
    "C13": "A22", "C14": "A23", "C15": "A12", "C16": "A25", "C17": "A21", "C18": "A20",
    "D01": "B05", "D02": "B07", "D03": "B08", "D04": "B09", "D05": "B10", "D06": "B02",
    "D07": "B03", "D08": "B27", "D09": "B28", "D10": "B29", "D11": "B22", "D12": "B20",
    "D13": "B21", "D14": "B24", "D15": "B30", "D16": "B31", "D17": "B32", "D18": "B34",
    "D19": "B35", "D20": "B16", "D21": "B17", "D22": "B12", "D23": "B13", "D24": "B14",
}
