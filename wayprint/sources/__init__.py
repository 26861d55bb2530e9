from wayprint.sources.documents import (
    count_rejected, document, document_field, document_fields, document_values, documents_table, format_row, query_documents,
    read_documents, variant_documents,
)
from wayprint.sources.registry import ONE_TASK, Registry, Split, frames, jdbc_database, parquet_directory

__all__ = [
    "count_rejected", "document", "document_field", "document_fields", "document_values", "documents_table", "format_row",
    "query_documents", "read_documents", "variant_documents", "ONE_TASK", "Registry", "Split", "frames", "jdbc_database", "parquet_directory",
]
