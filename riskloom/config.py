"""Configuration objects; feature roles and caps are data, never hard-coded in an operator."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Texts that mean "no value", compared in lower case after trimming.
JUNK_TEXTS = (
    "",
    "na",
    "n/a",
    "none",
    "null",
    "nil",
    "nan",
    "missing",
    "unknown",
    "error",
    "invalid",
    "undefined",
    "unavailable",
)

# A category seen fewer times than this is set to null.
RARE_MIN_COUNT = 7


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns are numeric, nominal and ordinal, and how each group is imputed."""

    numeric: tuple[str, ...] = ()
    nominal: tuple[str, ...] = ()
    ordinal: tuple[str, ...] = ()
    numeric_impute: str = "mean"
    nominal_impute: str = "most_frequent"
    ordinal_impute: str = "most_frequent"

    @property
    def columns(self) -> tuple[str, ...]:
        return self.numeric + self.nominal + self.ordinal


@dataclass(frozen=True)
class CleanSpec:
    """Rules of the cleaner. ``whitespace`` and ``count_nulls`` select the notebook variant of two rules."""

    rename: tuple[str, ...]
    target: str
    features: FeatureSpec
    drop: tuple[str, ...] = ()
    caps: dict[str, float] = field(default_factory=dict)
    min_count: int = RARE_MIN_COUNT
    min_share: float | None = None
    junk: tuple[str, ...] = JUNK_TEXTS
    whitespace: str = "trim"
    count_nulls: bool = False

    def notebook_variant(self, caps: dict[str, float]) -> "CleanSpec":
        """All white space removed, no junk list, nulls counted as a value, other caps."""
        return replace(self, caps=caps, whitespace="remove", count_nulls=True, junk=())


def clean_spec_from_dict(config: dict) -> CleanSpec:
    """Build the cleaner's rules from a nested configuration mapping (as read from YAML)."""
    cleaning = config["data_cleaning"]
    roles = config["preprocessing"]

    def group(name: str) -> dict:
        return roles.get(name, {})

    spec = FeatureSpec(
        numeric=tuple(group("numeric").get("features", ())),
        nominal=tuple(group("nominal").get("features", ())),
        ordinal=tuple(group("ordinal").get("features", ())),
        numeric_impute=group("numeric").get("imputer_strategy", "mean"),
        nominal_impute=group("nominal").get("imputer_strategy", "most_frequent"),
        ordinal_impute=group("ordinal").get("imputer_strategy", "most_frequent"),
    )
    return CleanSpec(
        rename=tuple(cleaning["rename_cols"]),
        target=config["base"]["target_col"],
        features=spec,
        drop=tuple(cleaning.get("drop_cols") or ()),
        caps=dict(cleaning.get("outlier_cols") or {}),
    )


def load_yaml(path: str) -> dict:
    """Read a YAML file on the driver; PyYAML is optional."""
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("PyYAML is needed to read a YAML configuration") from missing
    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle)
