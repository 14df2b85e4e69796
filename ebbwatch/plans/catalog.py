"""All registered queries and their SQL."""

from ebbwatch.plans import catalog_models, catalog_reports, catalog_streams, catalog_tables, catalog_text  # noqa: F401
from ebbwatch.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
