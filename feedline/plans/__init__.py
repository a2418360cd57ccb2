"""Whole jobs: the batch ingest run and the checks registered for the driver."""
