"""Registered queries: every public operator on the given tables, with the SQL that states its result."""

from demesne.queries import catalogs, comparisons, incremental, mining, outputs, relational, shredding, sources, streams, warehouse  # noqa: F401
from demesne.queries.registry import ORACLES, QUERIES  # noqa: F401
