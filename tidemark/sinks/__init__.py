from tidemark.sinks.writers import write_csv, write_document, write_table

__all__ = ["write_csv", "write_document", "write_table"]
