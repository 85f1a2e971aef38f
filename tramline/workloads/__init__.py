"""Registered queries: the jobs and operators bound to the shared test tables.

Each module has ``QUERIES`` (name → callable) and ``SQL`` (name → the same in plain SQL).
The tables have none of the city feeds' columns, so a binding first maps a table onto the
columns a job reads. Every query runs over its whole tables.
"""

from __future__ import annotations

from tramline.workloads import calendar, events, landings, loads, ridership, warehouse, weather

MODULES = (ridership, weather, events, loads, landings, warehouse, calendar)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
