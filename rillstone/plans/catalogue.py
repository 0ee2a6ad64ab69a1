"""The queries of the engine by name, with the SQL that gives the same rows.

The driver's tables stand in for the registry's: a record is a line of an
order with its customer's nation and region, its power the quantity, and lines
of low priority are market aggregates. Parts of the catalogue live in modules
beside this one.
"""

from __future__ import annotations

from rillstone.plans import entities, landed, marts, records, scalars, tables

FLAGSHIP = "q01_region_rollup"
QUERIES = {**marts.QUERIES, **tables.QUERIES, **entities.QUERIES, **scalars.QUERIES, **records.QUERIES, **landed.QUERIES}
ORACLES = {**marts.ORACLES, **tables.ORACLES, **entities.ORACLES, **scalars.ORACLES, **records.ORACLES, **landed.ORACLES}
