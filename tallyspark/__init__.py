"""tallyspark: retail cleaning, modelling and analytics as Spark DataFrame jobs.

Every public function takes DataFrames (plus plain parameters) and returns a
lazy DataFrame; nothing is collected except explicitly bounded driver steps
(one-row aggregates and per-partition offset tables).
"""

from tallyspark.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
