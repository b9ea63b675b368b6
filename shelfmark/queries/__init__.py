"""All registered queries and their checks."""

from shelfmark.queries import clean, courses, enrich, explore, jobs, repos  # noqa: F401
from shelfmark.queries.registry import ORACLES, QUERIES  # noqa: F401
