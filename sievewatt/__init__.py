"""Data-quality lakehouse operators for time-series readings, built on PySpark."""

from sievewatt.config import CheckSettings, Cols, RiskSettings, ScoreSettings, Settings

__all__ = ["CheckSettings", "Cols", "RiskSettings", "ScoreSettings", "Settings"]
