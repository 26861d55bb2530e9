"""Values taken out of text columns: JSON, URLs, comma lists, labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def json_field(col: str | Column, key: str) -> Column:
    """One top-level JSON value as text without quotes.

    Null when the key is missing, its value is null, or the text is not JSON.
    """
    return F.replace(F.get_json_object(col, f"$.{key}"), F.lit('"'), F.lit(""))


def json_fields(df: DataFrame, col: str, fields: Mapping[str, str]) -> DataFrame:
    """Adds several top-level JSON values, each text parsed once; ``fields`` maps key to column.

    Same rules as :func:`json_field`.
    """
    parsed = df.select("*", F.json_tuple(col, *fields).alias(*fields.values()))
    return parsed.withColumns({c: F.replace(c, F.lit('"'), F.lit("")) for c in fields.values()})


def url_segment(col: str | Column, index: int) -> Column:
    """Part ``index`` (from 0) of a URL split at ``/``, cut at ``?``; '' when the URL is short."""
    part = F.split_part(_col(col), F.lit("/"), F.lit(index + 1))
    return F.split_part(part, F.lit("?"), F.lit(1))


def split_codes(col: str | Column) -> Column:
    """Elements of a comma list; trailing empty elements are dropped, others kept.

    An empty list, or one of commas only, is a single empty element.
    """
    return F.split(F.regexp_replace(_col(col), ",+$", ""), ",")


def explode_codes(df: DataFrame, list_col: str, out: str) -> DataFrame:
    """One row per element of the comma list, the other columns repeated."""
    others = [c for c in df.columns if c != list_col]
    return df.select(*others, F.explode(split_codes(list_col)).alias(out))


def label_flag(col: str | Column, label: str) -> Column:
    """1 when the text contains the label, else 0; null for null text."""
    return _col(col).contains(label).cast("int")


def prefix_id(col: str | Column, prefixes: Mapping[str, str]) -> Column:
    """Id of the prefix the text starts with, or null.

    The table is part of the program, so it becomes a CASE expression in the
    scan's own stage: no join and nothing to broadcast. The longest prefix wins.
    """
    ordered = sorted(prefixes.items(), key=lambda item: -len(item[1]))
    case = F.lit(None).cast("string")
    for key, prefix in reversed(ordered):
        case = F.when(_col(col).startswith(prefix), F.lit(key)).otherwise(case)
    return case


def document_id(*keys: str) -> Column:
    """Display id of a document: its keys joined. Null when any key is null.

    Never group or join on it: ("1", "23") and ("12", "3") give the same id.
    """
    return F.concat(*[F.col(k) for k in keys])


def _col(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col
