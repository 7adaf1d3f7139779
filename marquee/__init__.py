"""marquee: rating and review reports as Spark DataFrame jobs.

Every public function takes and returns DataFrames; nothing here triggers an
action except the sinks in :mod:`marquee.sources.sinks`.
"""

from marquee.session import checkpoint_dir, get_session, scratch_path

__all__ = ["get_session", "checkpoint_dir", "scratch_path"]
