"""Time-series tables on Spark: ingest shaping, line-protocol text, bucketed SQL and data upkeep."""

from chronoloom.session import configure
from chronoloom.workspace import Workspace

__all__ = ["Workspace", "configure"]
