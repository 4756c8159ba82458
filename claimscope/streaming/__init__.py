"""Incremental data-quality checks on arriving claim files (Structured Streaming).

The original study has no streaming part; every job in this library is a
batch job.  The two checks that look at one row at a time (paid amount <= 0,
invalid days supply) need no state, so the same functions run unchanged on a
file stream: new claim or fill files are checked as they land and the
offending rows are appended to a table.  Checks that compare rows (duplicates,
eligibility, overlaps) stay batch jobs.
"""

from claimscope.streaming.row_checks import start_row_checks

__all__ = ["start_row_checks"]
