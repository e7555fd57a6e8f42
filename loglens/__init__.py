"""loglens — web-log analytics as lazy Spark DataFrame plans.

* :mod:`loglens.sources`   — JSON Lines logs (plain, date-partitioned), rejects,
  saved results, file inventory, and the log view over ``events``.
* :mod:`loglens.sinks`     — landing zones and result writers.
* :mod:`loglens.functions` — time columns, error predicate, exact percentages,
  deterministic top-k.
* :mod:`loglens.operators` — the named analyses (``DataFrame -> DataFrame``).
* :mod:`loglens.plans`     — SQL views, the whole report (one by one or from
  one grouping-sets scan), the query catalog and its SQL oracle.
* :mod:`loglens.streaming` — incremental landing of new log files.
"""

from .schema import LOG_SCHEMA, RAW_SCHEMA, RESULT_SCHEMAS

__all__ = ["LOG_SCHEMA", "RAW_SCHEMA", "RESULT_SCHEMAS"]
