"""tidewater: text, log, key-value, top-k, graph and event-time analytics on PySpark.

Every operator takes DataFrames and returns DataFrames. The work stays inside
Catalyst (built-in expressions, joins, aggregates, windows, state stores); Python
only drives loops whose body is one Spark job.
"""

from tidewater.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
