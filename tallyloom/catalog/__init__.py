"""Every inventory operator bound to the given tables, with its SQL check."""

from . import (  # noqa: F401
    basics, cleaning, dashboards, fitted_facts, models, relational, streams, texts, topics, topics_fitted,
)
from .registry import QUERIES, SQL  # noqa: F401
