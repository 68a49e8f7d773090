"""Lead ranking and record linkage as PySpark DataFrame operators."""
from .operators.evaluate import evaluate_rankings
from .operators.history import snapshot_score_run

__all__ = ["evaluate_rankings", "snapshot_score_run"]
