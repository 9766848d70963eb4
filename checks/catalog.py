"""Importing this module registers every query."""

from checks import q_aggregates, q_imputation, q_joins, q_matching, q_quality, q_scalars

__all__ = ["q_aggregates", "q_imputation", "q_joins", "q_matching", "q_quality", "q_scalars"]
