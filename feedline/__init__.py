"""feedline: incremental feed ingestion as Spark DataFrame jobs.

Landed payloads (paged JSON, JSON result sets, RSS items) are mapped into one
record envelope, filtered by per-source high-water marks, canonicalised,
validated, de-duplicated and written with run metrics and updated source state.
Every operator is a built-in Spark expression or DataFrame transformation.
"""

__version__ = "0.1.0"
