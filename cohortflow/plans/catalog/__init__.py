"""All registered queries."""

from cohortflow.plans.catalog import assembly, encoding, evaluating, files, modelling, profiling, rewrites, selecting, similarity
from cohortflow.plans.catalog.registry import ORACLE, QUERIES

__all__ = [
    "ORACLE", "QUERIES", "assembly", "encoding", "evaluating", "files", "modelling", "profiling", "rewrites",
    "selecting", "similarity",
]
