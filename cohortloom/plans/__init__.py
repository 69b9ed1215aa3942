"""Registered queries. Importing this package fills the registry."""

from cohortloom.plans import clinical, cohort, etl, evaluation, files, graph, joins, learning, matrix, rows  # noqa: F401
from cohortloom.plans.registry import ORACLES, QUERIES  # noqa: F401
