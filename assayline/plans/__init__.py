"""Layer builders: Silver verdicts, Gold aggregates, dashboard queries, jobs."""
