"""accrualkit — monthly sync-accrual (royalty) reporting on Spark.

Reusable DataFrame operators for key/value event logs and periodic
snapshots, plus the seven parameterised reports composed from them.
Everything is expressed with built-in Spark SQL functions so that
Catalyst can push filters into the scans, prune columns and plan the
shuffles; there are no Python UDFs anywhere in the library.
"""

from accrualkit.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
