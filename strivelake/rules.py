"""Benefit rules: a dataclass, loadable from the YAML rules file (section ``gold``)."""
from __future__ import annotations

import datetime as dt
import warnings
from dataclasses import dataclass, replace

# Fixed values that must equal the reference's canonical labels.
MARCHE = "Marche/running"
VELO = "Vélo/Trottinette/Autres"
TRANSPORTS = "Transports en commun"
VEHICULE = "véhicule thermique/électrique"


@dataclass(frozen=True)
class Rules:
    prime_rate: float = 0.05
    min_activities_for_wellbeing: int = 15
    wellbeing_days: int = 5
    sportive_commute_modes: tuple[str, ...] = (MARCHE, VELO)
    exclude_commute_anomaly: bool = True

    def with_(self, **kw) -> "Rules":
        return replace(self, **kw)


DEFAULT_RULES = Rules()

# Rules used with the driver fixtures (FIXTURES.md): the default minimum of 15
# would select nobody, since a customer has at most 9 orders a year.
FIXTURE_RULES = Rules(min_activities_for_wellbeing=3)
FIXTURE_AS_OF = dt.date(2002, 1, 1)


def load_rules(path: str | None) -> Rules:
    """Read ``gold:`` from a YAML file; missing keys keep the defaults, a missing file does so
    with a warning, and a path without the YAML package is an error."""
    if not path:
        return DEFAULT_RULES
    import yaml
    try:
        with open(path, encoding="utf-8") as fh:
            data = yaml.safe_load(fh) or {}
    except FileNotFoundError:
        warnings.warn(f"no rules file at {path}: the default rules apply", stacklevel=2)
        return DEFAULT_RULES
    gold = data.get("gold") if isinstance(data, dict) else None
    if not isinstance(gold, dict):
        return DEFAULT_RULES
    base = DEFAULT_RULES
    return Rules(
        prime_rate=float(gold.get("prime_rate", base.prime_rate)),
        min_activities_for_wellbeing=int(
            gold.get("min_activities_for_wellbeing", base.min_activities_for_wellbeing)),
        wellbeing_days=int(gold.get("wellbeing_days", base.wellbeing_days)),
        sportive_commute_modes=tuple(
            gold.get("sportive_commute_modes", list(base.sportive_commute_modes))),
        exclude_commute_anomaly=bool(
            gold.get("exclude_commute_anomaly", base.exclude_commute_anomaly)),
    )
