"""tidemark: incremental ingestion and change processing as PySpark DataFrame operators."""
