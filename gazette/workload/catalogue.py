"""All queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from gazette.workload import analysis, delivery, stores  # noqa: F401  (a module adds its queries where it is imported)
from gazette.workload import more_oracles
from gazette.workload.oracles import ORACLES as _ORACLES
from gazette.workload.queries import QUERIES as _QUERIES

QUERIES = _QUERIES
ORACLES = {**_ORACLES, **more_oracles.ORACLES}
