"""Whole pipelines built from the operators: Gold tables, reports, SQL, refresh and jobs."""
