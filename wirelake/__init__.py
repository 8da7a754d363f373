"""wirelake: packet-traffic analytics as Spark jobs.

Packets become a typed DataFrame (``sources``), header bytes are decoded by
column expressions (``functions``), per-capture features, dashboard panels,
report rows and clustering are DataFrame plans (``operators``), sliding-window
counters run on Structured Streaming (``streaming``), and ``plans`` holds the
query catalog used by ``__spark_entry__.py`` and ``bench.py``.
"""

from wirelake.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
