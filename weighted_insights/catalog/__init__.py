"""The registered queries.  Importing this package registers all of them."""

from . import cleaning, clustering, evaluation, preparing, profiling, records, training  # noqa: F401
from .registry import QUERIES, SQL_TWINS

__all__ = ["QUERIES", "SQL_TWINS"]
