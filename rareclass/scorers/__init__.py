"""Rare-class scorers: classifiers (M1-M5) and anomaly detectors (M6-M8)."""

from .anomaly import IsolationForestScorer, OneClassSVMScorer, ReconstructionScorer
from .knn import KNNScorer, knn_vote
from .supervised import BoostedScorer, ForestScorer, KernelSVMScorer, LogitScorer

SCORERS = {
    "logit": LogitScorer,
    "forest": ForestScorer,
    "boosted": BoostedScorer,
    "kernel_svm": KernelSVMScorer,
    "knn": KNNScorer,
    "iforest": IsolationForestScorer,
    "one_class_svm": OneClassSVMScorer,
    "recon_error": ReconstructionScorer,
}

__all__ = ["SCORERS", "knn_vote", "KNNScorer", "LogitScorer", "ForestScorer", "BoostedScorer", "KernelSVMScorer",
           "IsolationForestScorer", "OneClassSVMScorer", "ReconstructionScorer"]
