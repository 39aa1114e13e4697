"""Silver enrichment of employees: commute mode, travel mode, route distance, anomaly.

The reference calls a routing web service once per employee from the driver.
Here the distances come from a ``routes(home_address, travel_mode, meters)``
table and everything is a join: the work is spread over the cluster and an
address that no route covers is listed by :func:`missing_routes` instead of
aborting the job (D-14).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strivelake.functions.expressions import (
    canonical_commute_mode, commute_anomaly, commute_mode_with_precedence,
    max_allowed_km, meters_to_km, strip_ws, travel_mode,
)

COL_MODE_RAW = "Moyen_de_déplacement"
COL_HOME = "Adresse_du_domicile"
ENRICHED_COLUMNS = ["commute_mode", "google_travel_mode", "distance_km", "max_allowed_km",
                    "anomaly_commute"]


def with_commute_mode(df: DataFrame, raw_col: str = COL_MODE_RAW,
                      aliases: dict | None = None) -> DataFrame:
    """F-2/F-3/J-6: ``commute_mode`` = existing non-blank value, else canonical(raw)."""
    existing = F.col("commute_mode") if "commute_mode" in df.columns else None
    raw = F.col(raw_col) if raw_col in df.columns else F.lit(None).cast("string")
    if aliases is not None:
        mode = canonical_commute_mode(raw, aliases)
        if existing is not None:
            mode = F.coalesce(F.nullif(existing, F.lit("")), mode)
    else:
        mode = commute_mode_with_precedence(existing, raw)
    return df.withColumn("commute_mode", mode)


def with_travel_mode(df: DataFrame) -> DataFrame:
    """J-7: canonical mode -> (WALK, 15.0) / (BICYCLE, 25.0), else nulls."""
    return (df.withColumn("google_travel_mode", travel_mode("commute_mode"))
              .withColumn("max_allowed_km", max_allowed_km("commute_mode")))


def dedupe_routes(routes: DataFrame) -> DataFrame:
    """One distance per (home_address, travel_mode); the shortest wins if several."""
    return (routes.withColumn("home_address", strip_ws("home_address"))
            .groupBy("home_address", "travel_mode")
            .agg(F.min("meters").alias("meters")))


def _home_key(df: DataFrame, home_col: str) -> F.Column:
    if home_col not in df.columns:
        return F.lit(None).cast("string")
    home = strip_ws(home_col)
    return F.when(home != F.lit(""), home)


def with_commute_distance(df: DataFrame, routes: DataFrame, *, home_col: str = COL_HOME,
                          strict: bool = False) -> DataFrame:
    """J-8/F-4/F-5: left join on (home, travel mode) and flag distances above the maximum.

    Only employees with an eligible mode and a non-blank home look up a route
    (null/blank home -> no distance, anomaly false; D-9). ``strict=True`` raises
    when a needed route is missing (the reference's behaviour).
    """
    if "google_travel_mode" not in df.columns:
        df = with_travel_mode(df)
    home = _home_key(df, home_col)
    asks = home.isNotNull() & F.col("google_travel_mode").isNotNull()
    # rows without a key look nothing up: they get a spread key on the side that matches no
    # route (_asks false), so they do not meet in one partition
    keyed = (df.withColumn("_home", home).withColumn("_asks", asks)
             .withColumn("_at", F.when(asks, F.col("_home")).otherwise(
                 F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("string"))))
    r = dedupe_routes(routes).select(
        F.lit(True).alias("_asks"), F.col("home_address").alias("_at"),
        F.col("travel_mode").alias("google_travel_mode"),
        meters_to_km("meters").alias("_route_km"),
    )
    out = (keyed.join(r, ["_at", "google_travel_mode", "_asks"], "left")
           .withColumn("distance_km", F.col("_route_km"))
           .withColumn("anomaly_commute", commute_anomaly(F.col("distance_km"),
                                                          F.col("max_allowed_km"))))
    if strict:
        missing = out.filter(F.col("_home").isNotNull() & F.col("google_travel_mode").isNotNull()
                             & F.col("distance_km").isNull()).limit(1)
        if not missing.isEmpty():
            raise RuntimeError("routes: no distance for at least one employee "
                               "(see missing_routes)")
    return out.drop("_home", "_at", "_asks", "_route_km")


def enrich_employees(employees: DataFrame, routes: DataFrame, *, strict: bool = False) -> DataFrame:
    """C-3: ref/rh -> silver/rh_enriched (all sheet columns + the five commute columns)."""
    base_cols = [c for c in employees.columns if c not in ENRICHED_COLUMNS]
    df = with_travel_mode(with_commute_mode(employees))
    df = with_commute_distance(df, routes, strict=strict)
    return df.select(*base_cols, *ENRICHED_COLUMNS)


def missing_routes(employees: DataFrame, routes: DataFrame, *, home_col: str = COL_HOME) -> DataFrame:
    """J-9: distinct (home_address, travel_mode) needed by employees but absent from routes.

    This is the work list for whatever fetches distances from a routing service.
    """
    df = employees
    if "google_travel_mode" not in df.columns:
        df = with_travel_mode(with_commute_mode(df))
    need = (df.select(_home_key(df, home_col).alias("home_address"),
                      F.col("google_travel_mode").alias("travel_mode"))
            .filter(F.col("home_address").isNotNull() & F.col("travel_mode").isNotNull())
            .distinct())
    return need.join(routes.select(strip_ws("home_address").alias("home_address"), "travel_mode"),
                     ["home_address", "travel_mode"], "left_anti")


def only_employee(df: DataFrame, employee_id: int) -> DataFrame:
    """P-6: restrict to one employee (pushed down to the scan)."""
    return df.filter(F.col("employee_id") == F.lit(int(employee_id)))
