"""All registered queries with their oracle SQL."""

from formflow.plans.catalog import aggregates, dictionaries, io, joins, quality, reshaping, scalars, upserts, views
from formflow.plans.catalog.reshaping import flagship
from formflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]
