"""DataFrame -> DataFrame operators of the ingestion pipeline."""
