"""Imports every query module so that the registry is complete."""

from lathe.plans import q_core, q_eval, q_features, q_knn, q_models, q_prep, q_runs, q_scoring, q_stream  # noqa: F401
from lathe.plans.registry import ORACLES, QUERIES  # noqa: F401
