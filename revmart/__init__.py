"""revmart: a Spark-native review-analytics pipeline.

Landed Atom feed pages become review rows (landing zone), are conformed
(bronze), stamped (silver) and summarised into a monthly mart per app
version (gold). Every step is a ``DataFrame -> DataFrame`` function on the
public PySpark API, so Catalyst plans the whole chain and executors do the
work.
"""

from revmart.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
