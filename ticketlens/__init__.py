"""ticketlens: exploratory analytics of yearly violation-ticket files on Spark.

Layout:
  sources/    CSV reader with an explicit schema, driver tables, Parquet sink
  functions/  column expressions: dates, fiscal years, clock text, labels
  operators/  profiling, cleaning, frequencies, top-N, comparison, revenue
  plans/      the case-study questions and the registered query catalog
"""

from ticketlens.roles import DEFAULT_ROLES, Roles
from ticketlens.session import apply_scale, build_session, checkpoint_root, ensure_checkpoint_dir, scale_conf

__all__ = [
    "DEFAULT_ROLES",
    "Roles",
    "apply_scale",
    "build_session",
    "checkpoint_root",
    "ensure_checkpoint_dir",
    "scale_conf",
]
