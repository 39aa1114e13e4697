import pytest
from pyspark.sql import functions as F

from strivelake.operators import commute, profile
from strivelake.sources.reference import (
    declared_sports, load_reference, read_reference, sanitize_column, sanitize_columns,
)


def test_sanitize_column_names():
    assert sanitize_column(" Moyen de  déplacement ") == "Moyen_de_déplacement"
    assert sanitize_column("Pratique d'un sport") == "Pratique_dun_sport"
    assert sanitize_column("a,b;c{d}(e)=f") == "abcdef"
    assert sanitize_column("   ") == "col"


def test_sanitize_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a_b` int")
    with pytest.raises(ValueError, match="sanitise"):
        sanitize_columns(df)


def test_load_reference(spark, tmp_dir):
    df = spark.createDataFrame([("12", " VELO/Trottinette/Autres", "x")],
                               "`ID salarié` string, `Moyen de déplacement` string, `Adresse du domicile` string")
    df.write.parquet(f"{tmp_dir}/rh")
    rh = read_reference(spark, f"{tmp_dir}/rh", is_rh=True)
    assert rh.columns == ["employee_id", "Moyen_de_déplacement", "Adresse_du_domicile", "commute_mode"]
    r = rh.first()
    assert r.employee_id == 12 and r.commute_mode == "Vélo/Trottinette/Autres"
    assert dict(rh.dtypes)["employee_id"] == "bigint"


def test_load_reference_errors(spark, tmp_dir):
    with pytest.raises(ValueError, match="missing"):
        load_reference(spark.createDataFrame([(1,)], "x int"))
    with pytest.raises(ValueError, match="empty"):
        load_reference(spark.createDataFrame([], "`ID salarié` string"))
    bad = load_reference(spark.createDataFrame([("12a",)], "`ID salarié` string"))
    with pytest.raises(Exception, match="non-numeric"):
        bad.collect()
    assert load_reference(spark.createDataFrame([("7.0",)], "`ID salarié` string")).first()[0] == 7
    with pytest.raises(FileNotFoundError):
        read_reference(spark, f"{tmp_dir}/nothing-here")


def test_declared_sports(spark):
    df = spark.createDataFrame([(1, " Tennis "), (2, ""), (3, None), (4, "  ")],
                               "employee_id long, Pratique_dun_sport string")
    assert [tuple(r) for r in declared_sports(df).collect()] == [(1, "Tennis")]


def test_enrichment_and_missing_routes(spark):
    emp = spark.createDataFrame([
        (1, "Marche/Running", "addr-1"), (2, "velo/trottinette/autres", "addr-2"),
        (3, "Marche/running", None), (4, "Marche/running", "   "), (5, "Transports en commun", "addr-1"),
        (6, "Marche/running", "addr-9")],
        "employee_id long, `Moyen_de_déplacement` string, `Adresse_du_domicile` string")
    routes = spark.createDataFrame([("addr-1", "WALK", 16000), ("addr-1", "WALK", 20000),
                                    ("addr-2", "BICYCLE", 12345)],
                                   "home_address string, travel_mode string, meters long")
    got = {r.employee_id: r for r in commute.enrich_employees(emp, routes).collect()}
    assert (got[1].google_travel_mode, got[1].distance_km, got[1].anomaly_commute) == ("WALK", 16.0, True)
    assert (got[2].distance_km, got[2].max_allowed_km, got[2].anomaly_commute) == (12.345, 25.0, False)
    assert got[3].distance_km is None and got[3].anomaly_commute is False      # D-9 null home
    assert got[4].distance_km is None and got[4].max_allowed_km == 15.0
    assert got[5].google_travel_mode is None and got[5].anomaly_commute is False
    assert got[6].distance_km is None and got[6].anomaly_commute is False      # D-14 missing route
    missing = [tuple(r) for r in commute.missing_routes(emp, routes).collect()]
    assert missing == [("addr-9", "WALK")]
    with pytest.raises(RuntimeError):
        commute.with_commute_distance(commute.with_travel_mode(commute.with_commute_mode(emp)),
                                      routes, strict=True)


def test_profile(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "m string")
    assert [tuple(r) for r in profile.value_counts(df, "m").collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in profile.column_profile(df.withColumn("n", F.lit(1))).collect()] == [
        (1, "m", "string", 3), (2, "n", "int", 4)]


def test_read_reference_csv_sheet(spark, tmp_dir):
    df = spark.createDataFrame([("3", "Transports en commun"), ("4", "Cheval")],
                               "`ID salarié` string, `Moyen de déplacement` string")
    df.write.option("header", True).csv(f"{tmp_dir}/rh_csv")
    rh = read_reference(spark, f"{tmp_dir}/rh_csv", fmt="csv", is_rh=True)
    assert sorted((r.employee_id, r.commute_mode) for r in rh.collect()) == [
        (3, "Transports en commun"), (4, None)]


def test_null_ids_raise(spark):
    for df in (spark.createDataFrame([(1,), (None,)], "employee_id long"),
               spark.createDataFrame([("1",), (None,)], "employee_id string")):
        with pytest.raises(Exception, match="non-numeric employee_id: null"):
            load_reference(df, check_empty=False).collect()
