"""Scalar expressions of the pipeline, each a ``Column`` built from ``pyspark.sql.functions``.

All of them stay inside whole-stage codegen; lookups that the reference does with
Python dicts are literal maps, so they need neither a UDF nor a join.
"""
from __future__ import annotations

from collections.abc import Iterable

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from strivelake.rules import MARCHE, TRANSPORTS, VEHICULE, VELO

__all__ = [
    "COMMUTE_ALIASES", "TRAVEL_MODES", "SPORT_LABELS", "NO_DISTANCE_KEYWORDS",
    "strip_ws", "canonical_commute_mode", "commute_mode_with_precedence",
    "travel_mode", "max_allowed_km", "meters_to_km", "commute_anomaly",
    "clean_salary", "parse_ts", "activity_year", "sport_declared", "is_sportive",
    "duration_minutes", "km_label", "sport_label", "message_text", "as_text",
    "map_literal", "evaluate_once",
]

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (labels, aliases, limits).
# ---------------------------------------------------------------------------
# Commute-mode spellings (stripped, lower-cased) -> canonical label.
COMMUTE_ALIASES = {
    "transports en commun": TRANSPORTS,
    "véhicule thermique/électrique": VEHICULE,
    "vehicule thermique/electrique": VEHICULE,
    "marche/running": MARCHE,
    "vélo/trottinette/autres": VELO,
    "velo/trottinette/autres": VELO,
}
# Canonical label -> (routing travel mode, maximum plausible km).
TRAVEL_MODES = {
    MARCHE: ("WALK", 15.0),
    VELO: ("BICYCLE", 25.0),
}
# Sport name -> label used in notification text.
SPORT_LABELS = {
    "Runing": "course",
    "Randonnée": "randonnée",
    "Tennis": "tennis",
    "Badminton": "badminton",
    "Escalade": "escalade",
    "Natation": "natation",
    "Triathlon": "triathlon",
}
# Sports for which no distance is expected (substring of the lower-cased name).
NO_DISTANCE_KEYWORDS = (
    "escalade", "tennis", "badminton", "football", "basket", "rugby",
    "judo", "boxe", "équitation", "equitation", "voile",
)
# Plausible distance ranges in metres by keyword, checked in this order.
DISTANCE_RANGES = (
    (("triathlon",), 20_000, 120_000),
    (("natation",), 500, 5_000),
    (("randonn", "runing", "course"), 1_000, 17_500),
)
DEFAULT_DISTANCE_RANGE = (1_000, 20_000)


# Sentences of the notifications.
MESSAGE_RUN = "Bravo {name} ! Tu viens de courir {km} km en {minutes} min ! Quelle énergie ! 🔥🏅"
MESSAGE_HIKE = "Magnifique {name} ! Une randonnée de {km} km terminée en {minutes} min ! 🌄"
MESSAGE_DISTANCE = "Bravo {name} ! Tu viens de finir ton activité de {label} ({km} km) en {minutes} min ! 🔥"
MESSAGE_OTHER = "Bravo {name}, tu viens de finir ton activité de {label} qui t'a pris {minutes} min ! 🔥"


def sentence(text: str, fill: dict[str, Column]) -> Column:
    """The text with its {placeholders} replaced by columns (null when one of them is null)."""
    parts = string.Formatter().parse(text)
    return F.concat(*[p for literal, name, _, _ in parts
                      for p in ([F.lit(literal)] if literal else []) + ([fill[name]] if name else [])])


def map_literal(mapping: dict) -> Column:
    """A literal MAP built from a small fixed dict (folded into the plan)."""
    items = []
    for k, v in mapping.items():
        items.extend([F.lit(k), v if isinstance(v, Column) else F.lit(v)])
    return F.create_map(*items)


def evaluate_once(expr: Column) -> Column:
    """``explode(array(expr))``: a Generate that computes ``expr`` once per row.

    Filters on an expensive value (e.g. a ``from_json`` result) are otherwise
    pushed below the projection that computes it, and the optimizer inlines
    the expression into every reference of the filter condition.
    """
    return F.explode(F.array(expr))


def as_text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace (not only spaces)."""
    return F.regexp_replace(as_text(c), r"^\s+|\s+$", "")


# F-2 -----------------------------------------------------------------------
def canonical_commute_mode(raw: Column | str, aliases: dict | None = None) -> Column:
    """strip + lower, then alias lookup; unknown or null -> null."""
    table = map_literal(aliases or COMMUTE_ALIASES)
    return F.try_element_at(table, F.lower(strip_ws(raw)))


# F-3 -----------------------------------------------------------------------
def commute_mode_with_precedence(existing: Column | None, raw: Column | str) -> Column:
    """An existing non-blank commute mode wins, else canonicalise the raw value."""
    canon = canonical_commute_mode(raw)
    if existing is None:
        return canon
    return F.coalesce(F.nullif(existing, F.lit("")), canon)


# J-7 -----------------------------------------------------------------------
def travel_mode(mode: Column | str) -> Column:
    table = map_literal({k: v[0] for k, v in TRAVEL_MODES.items()})
    return F.try_element_at(table, as_text(mode))


def max_allowed_km(mode: Column | str) -> Column:
    table = map_literal({k: float(v[1]) for k, v in TRAVEL_MODES.items()})
    return F.try_element_at(table, as_text(mode))


# F-4 -----------------------------------------------------------------------
def meters_to_km(meters: Column | str) -> Column:
    """round(m / 1000, 3); exact for integer metres."""
    m = F.col(meters) if isinstance(meters, str) else meters
    return F.round(m.cast("double") / F.lit(1000.0), 3)


# F-5 -----------------------------------------------------------------------
def commute_anomaly(distance_km: Column, max_km: Column) -> Column:
    """distance above the mode's maximum; unknown distance or mode -> false."""
    return F.coalesce(distance_km > max_km, F.lit(False))


# F-6 -----------------------------------------------------------------------
def clean_salary(c: Column | str, dtype=None) -> Column:
    """Salary to double: numeric columns as they are (D-5); text: ',' -> '.',
    keep only [0-9.-], lenient cast (unparseable -> null)."""
    col = F.col(c) if isinstance(c, str) else c
    if dtype is not None and dtype.typeName() in (
            "double", "float", "long", "integer", "short", "byte", "decimal"):
        return col.cast("double")
    text = F.regexp_replace(F.regexp_replace(col.cast("string"), ",", "."), "[^0-9.-]", "")
    return text.try_cast("double")


# F-7 -----------------------------------------------------------------------
def parse_ts(c: Column | str) -> Column:
    """ISO-8601 text to timestamp; unparseable -> null (ANSI-safe)."""
    return F.try_to_timestamp(as_text(c))


def activity_year(c: Column | str) -> Column:
    return F.year(parse_ts(c))


# F-8 -----------------------------------------------------------------------
def sport_declared(c: Column | str) -> Column:
    """trim(x) <> '' with null -> false (Spark trim removes spaces only, as the source)."""
    return F.coalesce(F.trim(as_text(c)) != F.lit(""), F.lit(False))


# F-9 -----------------------------------------------------------------------
def is_sportive(mode: Column | str, modes: Iterable[str]) -> Column:
    """commute mode in the eligible list; null mode -> false (D-4)."""
    col = F.col(mode) if isinstance(mode, str) else mode
    return F.coalesce(col.isin(list(modes)), F.lit(False))


# F-16 ----------------------------------------------------------------------
def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """max(1, floor(seconds / 60)); null when either side does not parse (D-16)."""
    micros = F.unix_micros(parse_ts(end)) - F.unix_micros(parse_ts(start))
    # greatest() skips nulls, so keep an unparseable date null explicitly
    return F.when(micros.isNotNull(),
                  F.greatest(F.lit(1).cast("long"), F.floor(micros / F.lit(60_000_000))))


# F-17 ----------------------------------------------------------------------
def km_label(meters: Column | str) -> Column:
    """One decimal (half-even on the double, like Python's format), decimal comma."""
    m = F.col(meters) if isinstance(meters, str) else meters
    return F.regexp_replace(
        F.call_function("format_number", m.cast("double") / F.lit(1000.0), F.lit("0.0")), r"\.", ",")


# F-18 ----------------------------------------------------------------------
def sport_label(sport: Column | str) -> Column:
    s = as_text(sport)
    return F.coalesce(F.try_element_at(map_literal(SPORT_LABELS), s), F.lower(s))


# F-19 ----------------------------------------------------------------------
def message_text(full_name: Column, sport: Column, minutes: Column,
                 distance_m: Column, comment: Column) -> Column:
    """Notification text: four branches on sport and distance (0 counts as none),
    plus the optional quoted comment."""
    sport = F.coalesce(sport, F.lit("sport"))
    has_distance = F.coalesce(distance_m != F.lit(0), F.lit(False))
    km = km_label(distance_m)
    fill = {"name": full_name, "km": km, "minutes": minutes.cast("string"), "label": sport_label(sport)}
    body = (F.when((sport == F.lit("Runing")) & has_distance, sentence(MESSAGE_RUN, fill))
            .when((sport == F.lit("Randonnée")) & has_distance, sentence(MESSAGE_HIKE, fill))
            .when(has_distance, sentence(MESSAGE_DISTANCE, fill))
            .otherwise(sentence(MESSAGE_OTHER, fill)))
    suffix = F.when(F.coalesce(comment != F.lit(""), F.lit(False)),
                    F.concat(F.lit(' ("'), comment, F.lit('")'))).otherwise(F.lit(""))
    return F.concat(body, suffix)


# F-20 ----------------------------------------------------------------------
def expected_distance_range(sport: Column | str) -> tuple[Column, Column, Column]:
    """(distance expected?, min m, max m) from keywords in the lower-cased sport name."""
    s = F.lower(as_text(sport))
    no_distance = F.lit(False)
    for kw in NO_DISTANCE_KEYWORDS:
        no_distance = no_distance | s.contains(kw)
    lo = F.lit(DEFAULT_DISTANCE_RANGE[0])
    hi = F.lit(DEFAULT_DISTANCE_RANGE[1])
    for kws, kmin, kmax in reversed(DISTANCE_RANGES):
        cond = F.lit(False)
        for kw in kws:
            cond = cond | s.contains(kw)
        lo = F.when(cond, F.lit(kmin)).otherwise(lo)
        hi = F.when(cond, F.lit(kmax)).otherwise(hi)
    expected = F.coalesce(~no_distance, F.lit(True))
    return expected, F.when(expected, lo).cast("long"), F.when(expected, hi).cast("long")
