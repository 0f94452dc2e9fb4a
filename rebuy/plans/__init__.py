"""Composite plans: the feature/dataset plan, the model and the scoring job."""

from rebuy.plans.features import assemble_features, build_dataset

__all__ = ["assemble_features", "build_dataset"]
