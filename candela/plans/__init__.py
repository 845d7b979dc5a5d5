"""Operator registry (dispatch by name) and the catalog of checked queries."""

from candela.plans.registry import OPERATORS, SUMMARIES, run, run_many

__all__ = ["OPERATORS", "SUMMARIES", "run", "run_many"]
