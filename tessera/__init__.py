"""tessera — layered (bronze → silver → gold) time-series analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or ``-> Column``)
built from Spark SQL built-ins, so Catalyst sees one lazy plan per query.
"""

from tessera.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
