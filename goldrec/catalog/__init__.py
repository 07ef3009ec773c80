"""Every operator as a named query over the given tables."""

from goldrec.catalog import golden, names, reports, rows, scans, values  # noqa: F401
from goldrec.catalog.registry import CATALOG

__all__ = ["CATALOG"]
