"""Stored documents as tables for SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


REJECTED = "_rejected"


def read_documents(spark: SparkSession, path: str, fields: list[str] | None = None) -> DataFrame:
    """All documents of a collection, one JSON object per line, every value as text.

    A line that is no JSON object is kept as it stands in the column ``_rejected``, with
    all fields null; it is never dropped without notice (:func:`count_rejected`). Without
    ``fields`` the lines are read once more to find them.
    """
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
    if fields is None:
        found = reader.json(path, primitivesAsString=True)
        return found if REJECTED in found.columns else found.withColumn(REJECTED, F.lit(None).cast("string"))
    types = T.StructType([T.StructField(f, T.StringType()) for f in [*fields, REJECTED]])
    return reader.schema(types).json(path)


def count_rejected(documents: DataFrame) -> DataFrame:
    """``documents, rejected``: readable and unreadable lines of :func:`read_documents`."""
    rejected = F.col(REJECTED).isNotNull()
    return documents.agg(F.count_if(~rejected).alias("documents"), F.count_if(rejected).alias("rejected"))


def document(col: str | Column) -> Column:
    """JSON text as a VARIANT; null when it is no JSON object."""
    found = F.try_parse_json(col)
    return F.when(F.schema_of_variant(found).startswith("OBJECT"), found)


def document_field(doc: str | Column, field: str) -> Column:
    """A top-level value of a VARIANT document as text; null when the document lacks it."""
    quote = next((q for q in "'\"" if q not in field), None)
    if quote:
        return F.try_variant_get(doc, f"$[{quote}{field}{quote}]", "string")
    return F.try_variant_get(doc, "$", "map<string,string>")[field]


def variant_documents(df: DataFrame, json_col: str) -> DataFrame:
    """``doc``: the documents as VARIANT, for SQL that names fields, without knowing them before."""
    return df.select(document(json_col).alias("doc"))


def document_values(df: DataFrame, json_col: str) -> DataFrame:
    """``field, value`` of every field of every document, as text, in one scan of the documents."""
    docs = variant_documents(df, json_col).filter("doc is not null")
    exploded = docs.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("doc").outer()))
    return exploded.select(F.col("key").alias("field"), F.col("value").cast("string").alias("value"))


def document_fields(df: DataFrame, json_col: str) -> list[str]:
    """Names of all fields that any document has, in order.

    One aggregation merges the documents' schemas where they are read; the driver gets
    the merged schema alone.
    """
    merged = df.select(document(json_col).alias("doc")).agg(F.schema_of_variant_agg("doc").alias("kind")).first().kind
    empty = df.sparkSession.sql(f"SELECT CAST(NULL AS {merged.replace('OBJECT', 'STRUCT')}) AS doc") if merged and merged.startswith("OBJECT<") and merged != "OBJECT<>" else None
    return sorted(empty.schema["doc"].dataType.names) if empty is not None else []


def documents_table(df: DataFrame, json_col: str, fields: list[str] | None = None) -> DataFrame:
    """One text column per field, taken by name; a field a document lacks is null.

    Without ``fields``, the table has those of all documents, for which it reads them.
    """
    fields = document_fields(df, json_col) if fields is None else fields
    return variant_documents(df, json_col).select(*[document_field("doc", f).alias(f) for f in fields])


def query_documents(documents: DataFrame, sql: str) -> DataFrame:
    """Run a query over the documents, which it names ``{documents}``; no view of the session is touched."""
    return documents.sparkSession.sql(sql, documents=documents)


def format_row(**labels: str) -> Column:
    """``label:value`` pairs joined with ``|``; a null value prints as ``null``."""
    pairs = [F.concat(F.lit(f"{label}:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))
             for label, c in labels.items()]
    return F.concat_ws("|", *pairs)
