"""greenledger: emission-factor normalisation as Spark DataFrame operators.

Every public operator takes DataFrames and returns DataFrames built from
built-in Catalyst expressions; nothing iterates rows on the driver.

Layout:
    functions/  scalar column expressions (keys, concat rules, unit maths)
    sources/    bronze CSV scan/landing, lookup loading, publish/reconcile
    operators/  validation, lookups, naming rules, dimension, checks, usage
    plans/      per-source staging + cleaning, ingestion runner, queries
    streaming/  incremental (availableNow) landing of new bronze files
"""

from greenledger.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
