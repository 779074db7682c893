"""Composite jobs: operators wired into whole table-to-table jobs."""
