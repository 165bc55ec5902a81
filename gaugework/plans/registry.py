"""Imports every catalog module so their queries register (kept apart from ``catalog`` so
the query modules can import ``catalog`` and each other without a cycle)."""

from gaugework.plans import catalog
from gaugework.plans import q_geo, q_ingest, q_readings, q_rivers, q_stations, q_views  # noqa: F401
from gaugework.plans import q_rivers_view  # noqa: F401  (reuses the rainfall and overview SQL)

QUERIES = catalog.QUERIES
ORACLE = catalog.ORACLE
