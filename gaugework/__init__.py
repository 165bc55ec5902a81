"""gaugework: river-level, rainfall and flood-warning analytics as Spark DataFrame jobs.

Every public function takes DataFrames plus column names and returns a DataFrame.
Nothing is collected to the driver; time-dependent logic takes an explicit ``as_of``.
"""

from gaugework.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
