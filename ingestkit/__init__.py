"""ingestkit: table ingestion, change capture and merge operators on PySpark.

Every operator takes and returns ordinary DataFrames (or starts a
StreamingQuery) and leaves physical planning to Catalyst.
"""

__version__ = "0.1.0"
