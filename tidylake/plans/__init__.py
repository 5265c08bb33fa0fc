"""Layered flows (raw -> silver -> gold) composed from the operators."""

from tidylake.plans.layers import LabelRule, enrich_fact, refine_dimension, refine_fact

__all__ = ["LabelRule", "enrich_fact", "refine_dimension", "refine_fact"]
