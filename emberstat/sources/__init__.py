"""Sources and sinks: parquet tables, CSV, SQL text, literal frames,
sequences, documents, fitted models."""
