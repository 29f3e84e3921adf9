"""olapkit: warehouse, OLAP, event-log and data-modelling jobs on Spark."""

from .session import get_session

__version__ = "0.1.0"
__all__ = ["get_session"]
