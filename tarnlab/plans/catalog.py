"""All registered queries."""

from . import commits, files, inventory, measurement, reconciliation, resolution, scalars
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "commits", "files", "inventory", "measurement", "reconciliation", "resolution", "scalars"]
