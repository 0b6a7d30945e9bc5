"""Settings with the documented defaults, as plain dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Cols:
    """Which columns of a readings table play which part."""

    entity: tuple[str, ...] = ("household_id",)
    ts: str = "timestamp"
    value: str = "energy_kwh"
    arrival: str | None = "_ingestion_timestamp"


@dataclass(frozen=True)
class CheckSettings:
    interval_minutes: int = 30
    tolerance_minutes: float = 1.0
    daily_missing: float = 0.10
    weekly_missing: float = 0.25
    critical_missing: float = 0.25
    anomaly_rate: float = 0.05
    min_value: float = 0.0
    max_value: float = 50.0
    z_score: float = 5.0
    violation_rate: float = 0.01
    value_range: tuple[float, float] = (0.0, 100.0)
    enums: dict[str, list[str]] = field(
        default_factory=lambda: {
            "tariff_type": ["Std", "ToU"],
            "acorn_group": ["Affluent", "Comfortable", "Adversity", "ACORN-"],
        }
    )


@dataclass(frozen=True)
class ScoreSettings:
    completeness_weight: float = 0.40
    temporal_weight: float = 0.25
    business_weight: float = 0.20
    schema_weight: float = 0.15
    low_quality_threshold: float = 70.0

    @property
    def weights(self) -> dict[str, float]:
        return {
            "completeness_score": self.completeness_weight,
            "temporal_score": self.temporal_weight,
            "business_score": self.business_weight,
            "schema_score": self.schema_weight,
        }


@dataclass(frozen=True)
class RiskSettings:
    horizon_days: int = 1
    low_quality_threshold: float = 70.0
    high_incident_threshold: int = 5
    windows: tuple[int, ...] = (7, 30)
    model_type: str = "gbt"
    train_fraction: float = 0.8
    seed: int = 42
    max_iter: int = 100
    max_depth: int = 3
    step_size: float = 0.05
    subsampling_rate: float = 0.8
    feature_subset: str = "0.9"
    min_instances: int = 50
    min_info_gain: float = 0.0
    regularisation: float = 0.01
    model_path: str = "models/quality_risk_model"


@dataclass(frozen=True)
class Settings:
    """Everything a run needs. ``paths`` maps a source or layer name to a location."""

    paths: dict[str, str] = field(default_factory=dict)
    checks: CheckSettings = field(default_factory=CheckSettings)
    scoring: ScoreSettings = field(default_factory=ScoreSettings)
    risk: RiskSettings = field(default_factory=RiskSettings)
    limit_blocks: int | None = None
    steps_at_once: int = 4
    trigger_interval: str = "30 seconds"
    max_files_per_trigger: int = 100
    building_tags: tuple[str, ...] = ("building", "landuse", "amenity", "type")
    min_building_area: float = 0.0
    crs: str = "EPSG:4326"
    evolution_mode: str = "merge"
    allow_additional_columns: bool = True
    audit_retention_days: int = 365
    history_retention_days: int = 30

    @classmethod
    def from_dict(cls, raw: dict[str, Any]) -> "Settings":
        """Build from the nested YAML shape users already keep (paths, quality, ml, ...)."""
        paths = _flatten_paths(raw.get("paths", {}))
        quality = raw.get("quality", {})
        rules, schema = quality.get("business_rules", {}), quality.get("schema", {})
        base = CheckSettings()
        enums = dict(base.enums)
        if "allowed_tariffs" in schema:
            enums["tariff_type"] = list(schema["allowed_tariffs"])
        if "allowed_acorn_groups" in schema:
            enums["acorn_group"] = list(schema["allowed_acorn_groups"])
        temporal, complete = quality.get("temporal_coherence", {}), quality.get("completeness", {})
        checks = CheckSettings(
            interval_minutes=temporal.get("expected_interval_minutes", base.interval_minutes),
            anomaly_rate=temporal.get("anomaly_threshold", base.anomaly_rate),
            daily_missing=complete.get("daily_missing_threshold", base.daily_missing),
            weekly_missing=complete.get("weekly_missing_threshold", base.weekly_missing),
            min_value=rules.get("min_consumption", base.min_value),
            max_value=rules.get("max_consumption", base.max_value),
            z_score=rules.get("z_score_threshold", base.z_score),
            value_range=tuple(schema.get("energy_range", base.value_range)),
            enums=enums,
        )
        scoring = quality.get("scoring", {})
        score = ScoreSettings(
            scoring.get("completeness_weight", 0.40),
            scoring.get("temporal_coherence_weight", 0.25),
            scoring.get("business_rules_weight", 0.20),
            scoring.get("schema_validity_weight", 0.15),
            scoring.get("low_quality_threshold", 70.0),
        )
        ml = raw.get("ml", {}).get("quality_risk", {})
        boost, drisk = ml.get("lightgbm_params", {}), RiskSettings()
        logistic = ml.get("model_type") == "logistic_regression"
        risk = RiskSettings(
            horizon_days=ml.get("target_window_days", drisk.horizon_days),
            low_quality_threshold=ml.get("low_quality_threshold", drisk.low_quality_threshold),
            high_incident_threshold=ml.get("high_incident_threshold", drisk.high_incident_threshold),
            windows=tuple(ml.get("feature_windows", {}).get("missing_rate_days", drisk.windows)),
            model_type="logistic_regression" if logistic else "gbt",
            train_fraction=ml.get("train_test_split", drisk.train_fraction),
            seed=ml.get("random_state", drisk.seed),
            step_size=boost.get("learning_rate", drisk.step_size),
            subsampling_rate=boost.get("bagging_fraction", drisk.subsampling_rate),
            feature_subset=str(boost.get("feature_fraction", drisk.feature_subset)),
            model_path=ml.get("model_path", drisk.model_path),
        )
        stream, osm = raw.get("streaming", {}), raw.get("geospatial", {}).get("osm", {})
        governance = raw.get("governance", {})
        evolution = governance.get("schema_evolution", {})
        return cls(
            paths=paths,
            checks=checks,
            scoring=score,
            risk=risk,
            limit_blocks=raw.get("ingestion", {}).get("limit_blocks"),
            steps_at_once=raw.get("ingestion", {}).get("steps_at_once", 4),
            trigger_interval=stream.get("trigger_interval", "30 seconds"),
            max_files_per_trigger=stream.get("max_files_per_trigger", 100),
            building_tags=tuple(osm.get("building_tags", ("building", "landuse", "amenity"))),
            min_building_area=osm.get("min_building_area", 0.0),
            crs=osm.get("crs", "EPSG:4326"),
            evolution_mode=evolution.get("mode", "merge"),
            allow_additional_columns=evolution.get("allow_additional_columns", True),
            audit_retention_days=governance.get("audit_log", {}).get("retention_days", 365),
            history_retention_days=governance.get("versioning", {}).get("history_retention_days", 30),
        )

    @classmethod
    def from_yaml(cls, path: str) -> "Settings":
        import yaml

        with open(path, encoding="utf-8") as fh:
            return cls.from_dict(yaml.safe_load(fh))


def _flatten_paths(raw: dict[str, Any]) -> dict[str, str]:
    flat: dict[str, str] = {}
    for key, val in raw.items():
        if isinstance(val, dict):
            flat.update(_flatten_paths(val))
        else:
            flat[key] = val
    return flat
