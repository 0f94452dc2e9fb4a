"""Second-order boosted trees as Spark jobs: bins, histograms per level, rounds, and scoring from a node table."""

from rebuy.boosting.model import BoostedModel
from rebuy.boosting.rounds import BoostParams, fit, stop_round

__all__ = ["BoostParams", "BoostedModel", "fit", "stop_round"]
