"""strata: a Spark-native behaviour-analytics library.

Every public operator is a ``DataFrame (+ parameters) -> DataFrame`` function,
usable with ``df.transform``. Sources read, sinks write, operators compute;
nothing in the core path leaves the JVM.
"""

from strata.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
