"""What happened, per source: one row per event with the parts it adds to a profile.

Every fact has the columns of ``KEYS`` and some of ``PARTS``. All parts are whole
numbers that add up, amounts as limbs, so any set of facts, or any set of days, combines by summing:

- ``subject``: what the event is about (rest, lounge, parking, ...)
- ``itemized``: whether it belongs in a per-item document, or only in the user's
- ``user_id``, ``item_code``

Events without a user are dropped before any shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wayprint.constants import (
    ARTICLE_LABELS, ARTICLE_URL_PREFIX, BANNER_URL_PREFIXES, BROWSE_URLS, CODE_CLASSES, COMMENT_SCORE_ABOVE, DAY_ZONE,
)
from wayprint.functions import (
    any_prefix, has_prefix, in_values, in_window, json_fields, label_flag, limbs_of, not_blank,
    number_of, prefix_id, present, split_codes, url_segment, with_amount,
)
from wayprint.operators.joins import attach, only_keys
from wayprint.sources import Registry

KEYS = ["subject", "itemized", "user_id", "item_code"]
AMOUNT, CLASS = limbs_of("amount"), limbs_of("class")
PARTS = [
    *AMOUNT, "amount_n", "order_n", "usage_n", "people_sum", "browse_n",
    "collection_n", "comment_n", "favor_n", *CLASS, "class_n",
]
# Article labels as parts: they depend on a second table, so a stored state leaves them out.
LABEL_PARTS = [f"label_{field}" for field in ARTICLE_LABELS]


@dataclass(frozen=True)
class Window:
    """Whole days ``[start, end)`` of a zone; a missing bound is open."""

    start: dt.date | None = None
    end: dt.date | None = None
    zone: str = DAY_ZONE

    @classmethod
    def day_before(cls, as_of: dt.date, zone: str = DAY_ZONE) -> Window:
        return cls(as_of - dt.timedelta(days=1), as_of, zone)

    def filter(self, df: DataFrame, column: str) -> DataFrame:
        if self.start is None and self.end is None:
            return df
        return df.filter(in_window(df, column, self.start, self.end, self.zone))


@dataclass(frozen=True)
class Fact:
    """Builds the rows of one group of sources, for the wanted subjects and parts only."""

    subjects: frozenset[str]
    parts: frozenset[str]
    build: Callable[[Registry, Window, frozenset[str], frozenset[str], bool], DataFrame]

    def rows(
        self,
        registry: Registry,
        window: Window = Window(),
        subjects: Iterable[str] | None = None,
        parts: Iterable[str] | None = None,
        items: bool = True,
    ) -> DataFrame:
        """Without ``items``, rows may lack their item, and sources are summed by order or card before their joins."""
        subjects = self.subjects if subjects is None else self.subjects & frozenset(subjects)
        parts = self.parts & frozenset(PARTS if parts is None else parts)
        rows = self.build(registry, window, subjects, parts, items)
        return rows.select(*KEYS, *[
            F.col(p) if p in rows.columns else no_part(p) for p in [*PARTS, *LABEL_PARTS] if p in parts
        ])


def _orders(registry: Registry, window: Window, subjects: frozenset[str], parts: frozenset[str], items: bool) -> DataFrame:
    """Order lines of all products and uses of transfers, joined with the order header once.

    Restaurant and parking lines and transfer records carry their own time; the other
    products are dated by the header. For a span with a start, such as a day, these come
    from a join of their own, in which the filter reaches the header scan; and of the
    side without a time, only the orders of the span enter the join.

    In a full history, lines whose item is not wanted are counted by order number before
    they are shuffled, so one number that many lines share, such as that of no order,
    enters the join once. Restaurant lines have amounts and classes of their own and stay.
    """
    whole = window.start is None
    counted = parts & {*AMOUNT, "amount_n", "order_n"}
    classed = "rest" in subjects and parts & {*CLASS, "class_n"}
    own_time, header_time = [], []
    if "rest" in subjects and (counted or classed):
        own_time.append(_restaurant_lines(registry, window, whole and not items and not classed and not parts & {*AMOUNT, "amount_n"}))
    if "rest" in subjects and "usage_n" in parts:
        usage = window.filter(registry.table("td_restaurant_order"), "fd_date")
        own_time.append(_lines(usage, "rest", "fd_code", "fd_restaurant_code", used=True, counted=whole and not items))
    if "parking" in subjects:
        parking = window.filter(registry.table("tb_order_parking"), "create_date")
        own_time.append(_lines(parking.filter(present("parking_code")), "parking", "order_no", "parking_code", counted=whole and not items))
    if "cip" in subjects and "usage_n" in parts:
        own_time.append(_transfer_uses(registry, window, items))
    if "cip" in subjects and counted:
        cip = registry.table("tb_order_cip").filter(present("pro_code"))
        header_time.append(_lines(cip, "cip", "order_no", "pro_code", counted=whole and not items))
    if "vvip" in subjects:
        header_time.append(_lines(registry.table("tb_order_vvip"), "vvip", "order_no", counted=whole))
    if "car" in subjects:
        header_time.append(_lines(registry.table("tb_order_limousine"), "car", "order_no", counted=whole))

    header = registry.table("tb_order")
    if window.start is None:
        rows = _with_header([_union(own_time + header_time)], header)
        if window.end is not None:
            in_span = in_window(rows, "cdate", end=window.end, zone=window.zone)
            rows = rows.filter(~in_values("subject", ["cip", "vvip", "car"]) | F.col("used") | in_span)
    else:
        joined = []
        if own_time:
            lines = _union(own_time)
            joined.append(_with_header([lines], registry.narrowed("tb_order", lines, "order_no")))
        if header_time:
            head = window.filter(header, "cdate").filter(present("user_id"))
            joined.append(_with_header(_narrowed_lines(registry, header_time, head), head))
        rows = _union(joined)

    # An order counts when its header has an amount, whatever number that is.
    by_header = (F.col("subject") != "rest") & ~F.col("used")
    rows = rows.filter(~by_header | present("actual_amount"))
    if parts & {*AMOUNT, "amount_n"}:
        amount = F.when(by_header, number_of(rows, "actual_amount"))
        if "amount" in rows.columns:
            amount = F.coalesce(amount, number_of(rows, "amount"))
        rows = with_amount(rows, amount, "amount").withColumn("amount_n", F.expr("if(amount_whole is not null, uses, null)"))
        rows = rows.withColumns({limb: F.col(limb) * F.col("uses") for limb in AMOUNT})
    rows = (
        rows.withColumn("itemized", in_values("subject", ["rest", "parking", "cip"]))
        .withColumn("order_n", F.when(~F.col("used"), F.col("uses")))
        .withColumn("usage_n", F.when(F.col("used"), F.col("uses")))
    )
    return _classed(rows, registry, parts) if classed else rows


def _with_header(lines: list[DataFrame], header: DataFrame) -> DataFrame:
    """Lines with the user of their order; tables laid out by order number are joined one by one."""
    return _union([attach(df, header, {"order_no": "order_no"}, require=["user_id"]) for df in lines])


def _narrowed_lines(registry: Registry, lines: list[DataFrame], head: DataFrame) -> list[DataFrame]:
    """Lines of full tables for a join with a span's headers that moves no full table."""
    if registry.laid_out("tb_order_cip", "tb_order_vvip", "tb_order_limousine"):
        return lines
    return [only_keys(_union(lines), head, "order_no")]


def _restaurant_lines(registry: Registry, window: Window, counted: bool) -> DataFrame:
    lines = window.filter(registry.table("restaurant_order_detail2"), "ordertime").withColumnRenamed("xfprice", "amount")
    return _lines(lines, "rest", "fd_code", "fd_restaurant_code", extra=["amount", "fd_class"], counted=counted)


def _classed(rows: DataFrame, registry: Registry, parts: frozenset[str]) -> DataFrame:
    """Order rows with the scores of their dish classes.

    Rows are summed by their keys and class before they meet the classes, so a class
    enters the join once for each user and restaurant, and a frequent one is no hot key
    of lines. Classes are one row each, so nothing is repeated.
    """
    scores = with_amount(registry.table("restaurant_class"), "fd_cls", "class").filter(present("fd_class", "class_whole"))
    # Grouped by a second column, so that the join shuffles both sides itself: only then does Spark split hot keys.
    scores = scores.groupBy("fd_class", F.hash("fd_class")).agg(
        *[F.sum(c).alias(f"_{c}") for c in CLASS], F.count(F.lit(1)).alias("_class_n")).drop("hash(fd_class)")
    sums = [p for p in PARTS if p in parts and p in rows.columns]
    added = rows.groupBy(*KEYS, "fd_class").agg(*[F.sum(p).alias(p) for p in dict.fromkeys([*sums, "order_n"])])
    found = attach(added, scores, {"fd_class": "fd_class"})
    return found.withColumns({c: F.col("order_n") * F.col(f"_{c}") for c in [*CLASS, "class_n"]})


def _lines(
    df: DataFrame, subject: str, order_no: str, item_code: str | None = None,
    used: bool = False, extra: Iterable[str] = (), counted: bool = False,
) -> DataFrame:
    """Lines of a product; ``uses`` is how many a row stands for. Lines that are ``counted`` are one row an order."""
    lines = df.filter(present(order_no)).withColumn("_order", F.col(order_no))
    if counted:
        lines, item_code, extra = lines.groupBy("_order").agg(F.count(F.lit(1)).alias("_lines")), None, ()
    return lines.select(
        F.lit(subject).alias("subject"),
        F.lit(used).alias("used"),
        F.col("_order").alias("order_no"),
        (F.col(item_code) if item_code else F.lit(None).cast("string")).alias("item_code"),
        (F.col("_lines") if counted else F.expr("1L")).alias("uses"),
        *extra,
    )


def _transfer_uses(registry: Registry, window: Window, items: bool) -> DataFrame:
    """Uses of airport transfers as order lines: records and products that share an order number.

    Records are counted per order before they meet the products, so an order with
    many of both is not multiplied out, and so are products per order and code. For
    a day, only the products of its orders enter the join.
    """
    records = (
        window.filter(registry.table("tb_order_cip_record"), "create_time")
        .filter(present("order_no")).groupBy("order_no").agg(F.count(F.lit(1)).alias("records"))
    )
    products = registry.table("tb_order_cip")
    if window.start is not None:
        products = registry.narrowed("tb_order_cip", records, "order_no")
    products = products.filter(present("order_no", "pro_code")).groupBy("order_no", *["pro_code"] * items).agg(F.count(F.lit(1)).alias("products"))
    used = attach(records, products, {"order_no": "order_no"}, require=["products"])
    return used.select(
        F.lit("cip").alias("subject"), F.lit(True).alias("used"), "order_no",
        (F.col("pro_code") if items else F.lit(None).cast("string")).alias("item_code"),
        (F.col("records") * F.col("products")).alias("uses"),
    )


def _lounges(registry: Registry, window: Window, subjects: frozenset[str], parts: frozenset[str], items: bool) -> DataFrame:
    """Lounge visits and services, by membership card, joined once with the card's users.

    Both are summed per card and lounge first, or per card alone where items are not
    wanted: a card with a large share of all visits reaches the join as one row per lounge.
    The lounges that a service lists become rows of their own after the join.
    """
    added = []
    if parts & {*AMOUNT, "amount_n", "usage_n", "people_sum"}:
        visits = window.filter(registry.table("tblconsumerecord"), "consumetime")
        added.append(visits.filter(present("dragoncode", "loungecode")).select(
            "dragoncode", F.col("loungecode").alias("item_code"), F.lit(False).alias("listed"),
            F.col("point").alias("amount_whole"),
            _one_if("point is not null").alias("amount_n"),
            F.expr("1L as usage_n"),
            F.when(has_prefix("loungecode", "N"), F.col("personcount")).alias("people_sum"),
        ))
    if "order_n" in parts:
        services = window.filter(registry.table("tb_order_loungeserv"), "create_date")
        n = F.expr("1L") if items else F.size(split_codes("lounge_code")).cast("bigint")
        added.append(services.filter(present("dragoncode", "lounge_code")).select(
            "dragoncode", F.col("lounge_code").alias("item_code"), F.lit(True).alias("listed"), n.alias("order_n")))
    per_card = sum_parts(_union(added), ["dragoncode", "item_code", "listed"] if items else ["dragoncode"])
    cards = registry.table("tb_bindrecord")
    if window.start is not None:
        cards = registry.narrowed("tb_bindrecord", per_card, "dragoncode")
    item = F.lit(None).cast("string")
    if items:
        item = F.explode(F.when(F.col("listed"), split_codes("item_code")).otherwise(F.array("item_code"))) if "order_n" in parts else F.col("item_code")
    return attach(per_card, cards, {"dragoncode": "dragoncode"}, require=["user_id"]).select(
        F.lit("lounge").alias("subject"), F.lit(True).alias("itemized"), "user_id", item.alias("item_code"),
        *[c for c in per_card.columns if c in PARTS],
    )


# Key of the item in a page's parameters; subjects not listed have no item page.
_BROWSED_ITEM = {"rest": "code", "lounge": "code", "shop": "code", "parking": "parkingCode"}


def _browses(registry: Registry, window: Window, subjects: frozenset[str], parts: frozenset[str], items: bool) -> DataFrame:
    """Page views of all subjects in one scan of the page log, each parameter text parsed once."""
    subject, item = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in sorted(subjects):
        subject = F.when(in_values("url", BROWSE_URLS[name]), F.lit(name)).otherwise(subject)
        if name in _BROWSED_ITEM:
            item = F.when(F.col("subject") == name, F.col(_BROWSED_ITEM[name])).otherwise(item)
    keys = {"userId": "user_id", **{_BROWSED_ITEM[s]: _BROWSED_ITEM[s] for s in sorted(subjects) if s in _BROWSED_ITEM}}
    urls = [u for s in sorted(subjects) for u in BROWSE_URLS[s]]
    views = window.filter(registry.table("tbd_url_element").filter(in_values("url", urls)), "create_time")
    return (
        json_fields(views.select(subject.alias("subject"), "param"), "param", keys)
        .filter(not_blank("user_id"))
        .withColumn("item_code", item)
        .withColumn("itemized", not_blank("item_code"))
        .withColumn("item_code", F.when(F.col("itemized"), F.col("item_code")))
        .withColumn("browse_n", F.expr("1L"))
    )


def _collections(registry: Registry, window: Window, subjects: frozenset[str], parts: frozenset[str], items: bool) -> DataFrame:
    """Collected items of all subjects in one scan; the code's first letter tells the subject."""
    letters = {letter: s for letter, s in CODE_CLASSES.items() if s in subjects}
    collects = window.filter(registry.table("tb_user_collect"), "create_time")
    return (
        collects.filter(any_prefix("code", letters)).filter(present("user_id"))
        .select(prefix_subject("code", letters).alias("subject"), F.lit(True).alias("itemized"),
                "user_id", F.col("code").alias("item_code"), F.expr("1L as collection_n"))
    )


def _comments(registry: Registry, window: Window, subjects: frozenset[str], parts: frozenset[str], items: bool) -> DataFrame:
    """Comments on restaurants, and well-scored comments on lounges."""
    found = []
    if "rest" in subjects:
        found.append(("rest", "R", registry.table("customer_share")))
    if "lounge" in subjects:
        lounge = registry.table("tb_customer_share").filter(F.col("score") > COMMENT_SCORE_ABOVE)
        found.append(("lounge", "N", lounge))
    return _union([
        window.filter(df, "create_time").filter(has_prefix("code", letter) & present("user_id"))
        .select(F.lit(subject).alias("subject"), F.lit(True).alias("itemized"),
                "user_id", F.col("code").alias("item_code"), F.expr("1L as comment_n"))
        for subject, letter, df in found
    ])


def _visits(registry: Registry, window: Window, subjects: frozenset[str], parts: frozenset[str], items: bool) -> DataFrame:
    """Article and banner pages in one scan of the visit log."""
    prefixes = []
    is_article = F.lit(False)
    if "article" in subjects:
        prefixes.append(ARTICLE_URL_PREFIX)
        is_article = has_prefix("url", ARTICLE_URL_PREFIX)
    if "banner" in subjects:
        prefixes.extend(BANNER_URL_PREFIXES.values())
    visits = window.filter(registry.table("tbd_visit_url"), "create_time")
    rows = (
        visits.filter(present("user_id") & any_prefix("url", prefixes))
        .select(
            "user_id",
            F.when(is_article, "article").otherwise("banner").alias("subject"),
            F.when(is_article, url_segment("url", 4)).otherwise(prefix_id("url", BANNER_URL_PREFIXES)).alias("item_code"),
        )
        .withColumn("itemized", not_blank("item_code"))
        .withColumn("item_code", F.when(F.col("itemized"), F.col("item_code")))
        .withColumn("browse_n", F.expr("1L"))
    )
    return _labelled(rows, registry) if parts & frozenset(LABEL_PARTS) else rows


def _labelled(rows: DataFrame, registry: Registry) -> DataFrame:
    """Views with the labels of their articles, summed by user and item first.

    A popular article enters the join once per user and not once per view. An article
    without a row counts as having no labels; one whose labels are null has no label
    parts, and neither has a banner or a page without an item.
    """
    views = sum_parts(rows, KEYS).withColumn("_article", F.when((F.col("subject") == "article") & F.col("itemized"), F.col("item_code")))
    labels = registry.table("tbd_belles_lettres").withColumn("_known", F.lit(True))
    found = attach(views, labels, {"_article": "id"})
    text = F.when(F.col("_known"), F.col("person_labels")).when(present("_article"), F.lit(""))
    found = found.withColumn("_labels", text)
    return found.withColumns({
        part: label_flag("_labels", label) * F.col("browse_n") for part, label in zip(LABEL_PARTS, ARTICLE_LABELS.values())
    })


def _favors(registry: Registry, window: Window, subjects: frozenset[str], parts: frozenset[str], items: bool) -> DataFrame:
    favors = window.filter(registry.table("tbd_lettres_favor"), "create_time")
    return favors.filter(present("user_id", "lettres_id")).select(
        F.lit("article").alias("subject"), F.lit(True).alias("itemized"),
        "user_id", F.col("lettres_id").alias("item_code"), F.expr("1L as favor_n"),
    )


def _fact(build, subjects: Iterable[str], parts: Iterable[str]) -> Fact:
    return Fact(frozenset(subjects), frozenset(parts), build)


FACTS = {
    "orders": _fact(_orders, ["rest", "parking", "cip", "vvip", "car"],
                    [*AMOUNT, "amount_n", "order_n", "usage_n", *CLASS, "class_n"]),
    "lounges": _fact(_lounges, ["lounge"], [*AMOUNT, "amount_n", "order_n", "usage_n", "people_sum"]),
    "browses": _fact(_browses, BROWSE_URLS, ["browse_n"]),
    "collections": _fact(_collections, CODE_CLASSES.values(), ["collection_n"]),
    "comments": _fact(_comments, ["rest", "lounge"], ["comment_n"]),
    "visits": _fact(_visits, ["article", "banner"], ["browse_n", *LABEL_PARTS]),
    "favors": _fact(_favors, ["article"], ["favor_n"]),
}


def no_part(part: str) -> Column:
    return F.expr(f"cast(null as bigint) as {part}")


def sum_parts(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Parts added up per key; a part no row has stays null."""
    parts = [p for p in [*PARTS, *LABEL_PARTS] if p in df.columns]
    return df.groupBy(*keys).agg(*[F.expr(f"sum({p}) as {p}") for p in parts])


def other_visits(registry: Registry, window: Window = Window()) -> DataFrame:
    """Visits by known users to pages that are no banner page."""
    visits = window.filter(registry.table("tbd_visit_url"), "create_time")
    return visits.filter(present("user_id", "url") & ~any_prefix("url", BANNER_URL_PREFIXES.values()))


def rejected_page_views(registry: Registry, window: Window = Window()) -> DataFrame:
    """Browse URLs whose parameters name no user, counted per URL."""
    urls = [u for found in BROWSE_URLS.values() for u in found]
    views = window.filter(registry.table("tbd_url_element").filter(in_values("url", urls)), "create_time")
    rejected = json_fields(views, "param", {"userId": "user_id"}).filter(~not_blank("user_id"))
    return rejected.groupBy("url").agg(F.count(F.lit(1)).alias("rejected"))


def prefix_subject(col: str, letters: dict[str, str]) -> Column:
    case = F.lit(None).cast("string")
    for letter, subject in letters.items():
        case = F.when(has_prefix(col, letter), F.lit(subject)).otherwise(case)
    return case


def _one_if(condition: str) -> Column:
    return F.expr(f"if({condition}, 1L, null)")


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
