"""Spark-native analytics for entity x item x year panels."""

from yearloom.spec import FEATURES, PanelSpec

__all__ = ["FEATURES", "PanelSpec"]
