"""The claims jobs: cohorts, adherence, utilization, cost, data quality, summary."""
