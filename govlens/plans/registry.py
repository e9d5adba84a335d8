"""Imports every query module so the registry is complete."""

from govlens.plans import q_prep, q_insights, q_models, q_charts  # noqa: F401
from govlens.plans.queries import REGISTRY  # noqa: F401
