"""All registered driver queries and their SQL oracles."""

from __future__ import annotations

from tidemark.plans import basic

REGISTRY: dict = {}
ORACLE: dict = {}

for _module in (basic,):
    REGISTRY.update(_module.REGISTRY)
    ORACLE.update(_module.ORACLE)

from tidemark.plans import io_queries, mart_queries, staging  # noqa: E402

for _module in (mart_queries, io_queries, staging):
    REGISTRY.update(_module.REGISTRY)
    ORACLE.update(_module.ORACLE)
