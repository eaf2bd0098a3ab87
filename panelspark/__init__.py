"""panelspark: Spark-native entity-time panel features, sequences, folds,
model stacking and ranking metrics.  See README.md."""

from .spec import PanelSpec, get_session

__all__ = ["PanelSpec", "get_session"]
