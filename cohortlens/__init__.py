"""cohortlens: claims-cohort analytics expressed as Spark DataFrame plans.

Every operator takes and returns DataFrames; column names are parameters
so one implementation serves claim files and the driver's star schema.
"""

from cohortlens.session import build_session, configure, checkpoint_dir

__all__ = ["build_session", "configure", "checkpoint_dir"]
