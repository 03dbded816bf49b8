"""corpusflow: corpus preparation and run-log analytics as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, so Catalyst sees one logical plan per query and can prune
columns, push filters into the parquet scan and pick join strategies.
"""

from corpusflow.session import get_session, shared_path

__all__ = ["get_session", "shared_path"]
