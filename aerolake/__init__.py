"""aerolake: flight-delay analytics and scoring as Spark DataFrame functions.

Every public function takes and returns DataFrames (batch or streaming) and is
built from Spark SQL built-ins, ``pyspark.ml`` and Structured Streaming.
"""

from aerolake.session import get_session, shared_path

__all__ = ["get_session", "shared_path"]
