"""claimscope — claims cohort, adherence, utilization, cost and data-quality jobs on Spark.

Subpackages:

* ``sources``   — read the ten claims tables with their declared schema, defaults, writers, layouts
* ``functions`` — column expressions (dates, exact decimal ratios, labels)
* ``operators`` — reusable DataFrame operators (interval merge, distributed rank, block join, …)
* ``plans``     — the jobs, the report runner and the registry of driver keys
* ``streaming`` — row-level checks over arriving files
"""

__version__ = "0.1.0"
