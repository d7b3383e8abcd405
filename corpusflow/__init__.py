"""corpusflow: document ingestion, chunking, PII masking and hybrid retrieval
expressed as Spark DataFrame operators.

Every public operator takes DataFrames (or Columns) and returns a DataFrame
(or Column), so it composes with ``df.transform(...)`` and stays a lazy plan
that Catalyst optimises as a whole.
"""

from corpusflow.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
__version__ = "0.1.0"
