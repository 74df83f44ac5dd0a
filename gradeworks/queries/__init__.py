"""Registered queries: one per operator, each with its SQL where SQL can say it."""

from gradeworks.queries import cleaning, evaluation, guards, learning, models, profiling, runs, sampling, sources
from gradeworks.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning", "evaluation", "guards", "learning", "models", "profiling", "runs", "sampling", "sources"]
