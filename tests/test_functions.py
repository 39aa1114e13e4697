import math

from pyspark.sql import functions as F

from strivelake.functions import expressions as X


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("x")).alias("y")).first()["y"]


def test_canonical_commute_mode(spark):
    cases = {
        "  Marche/Running ": "Marche/running",
        "VELO/Trottinette/Autres": "Vélo/Trottinette/Autres",
        "vélo/trottinette/autres": "Vélo/Trottinette/Autres",
        "\tTransports en commun\n": "Transports en commun",
        "Vehicule thermique/electrique": "véhicule thermique/électrique",
        "Cheval": None,
        "": None,
        None: None,
    }
    for raw, want in cases.items():
        assert one(spark, X.canonical_commute_mode, raw) == want, raw


def test_mode_precedence_existing_wins(spark):
    df = spark.createDataFrame([("Marche/running", "Cheval"), ("", "velo/trottinette/autres"),
                                (None, "Cheval")], "m string, raw string")
    got = [r[0] for r in df.select(X.commute_mode_with_precedence(F.col("m"), F.col("raw"))).collect()]
    assert got == ["Marche/running", "Vélo/Trottinette/Autres", None]


def test_clean_salary_text_and_numeric(spark):
    cases = {"18638.40": 18638.4, "18638,40": 18638.4, "18638.40 €": 18638.4, "n/a": None,
             "1 234,5": 1234.5, "-12": -12.0, None: None, "1.2.3": None}
    for raw, want in cases.items():
        got = one(spark, X.clean_salary, raw)
        assert got == want, (raw, got)
    # D-5: numeric salaries are used as they are (no text round trip of 1.0E7)
    df = spark.createDataFrame([(1.0e7,)], "s double")
    assert df.select(X.clean_salary("s", df.schema["s"].dataType)).first()[0] == 1.0e7


def test_sport_declared_trims_spaces_only(spark):
    for raw, want in {"Tennis": True, "  ": False, "": False, None: False}.items():
        assert one(spark, X.sport_declared, raw) is want


def test_is_sportive_null_is_false(spark):
    modes = ("Marche/running", "Vélo/Trottinette/Autres")
    for raw, want in {"Marche/running": True, "Cheval": False, None: False}.items():
        assert one(spark, lambda c: X.is_sportive(c, modes), raw) is want


def test_duration_minutes(spark):
    df = spark.createDataFrame([
        ("2025-01-01T10:00:00Z", "2025-01-01T10:45:59Z", 45),
        ("2025-01-01T10:00:00Z", "2025-01-01T09:59:00Z", 1),     # negative -> at least 1
        ("2025-01-01T10:00:00Z", "2025-01-01T10:00:30Z", 1),
        ("not-a-date", "2025-01-01T10:00:30Z", None),           # D-16: null, not 1
    ], "s string, e string, want long")
    for r in df.select(X.duration_minutes("s", "e").alias("d"), "want").collect():
        assert r["d"] == r["want"]


def test_km_label_matches_python_format(spark):
    ms = list(range(0, 3000)) + [1050, 1150, 1250, 2450, 12345, 17499, 119950, 120000]
    df = spark.createDataFrame([(m,) for m in ms], "m long")
    got = {r[0]: r[1] for r in df.select("m", X.km_label("m")).collect()}
    for m in ms:
        assert got[m] == f"{m / 1000:.1f}".replace(".", ","), m


def test_sport_label(spark):
    for raw, want in {"Runing": "course", "Randonnée": "randonnée", "Voile": "voile",
                      "SIGNUP": "signup"}.items():
        assert one(spark, X.sport_label, raw) == want


def _expected_message(name, sport, minutes, dist, comment):
    # the rule of the notification text, written from its specification
    def km(m):
        return f"{m / 1000:.1f}".replace(".", ",")
    labels = X.SPORT_LABELS
    if sport == "Runing" and dist:
        t = f"Bravo {name} ! Tu viens de courir {km(dist)} km en {minutes} min ! Quelle énergie ! 🔥🏅"
    elif sport == "Randonnée" and dist:
        t = f"Magnifique {name} ! Une randonnée de {km(dist)} km terminée en {minutes} min ! 🌄"
    elif dist:
        t = (f"Bravo {name} ! Tu viens de finir ton activité de {labels.get(sport, sport.lower())} "
             f"({km(dist)} km) en {minutes} min ! 🔥")
    else:
        t = (f"Bravo {name}, tu viens de finir ton activité de {labels.get(sport, sport.lower())} "
             f"qui t'a pris {minutes} min ! 🔥")
    if comment:
        t += f' ("{comment}")'
    return t


def test_message_text_branches(spark):
    rows = [("Ana B", "Runing", 30, 5230, None), ("Ana B", "Runing", 30, 0, "x"),
            ("Un collègue", "Randonnée", 95, 12000, "Belle séance"),
            ("Ana B", "Natation", 40, 1500, ""), ("Ana B", "Tennis", 60, None, "top"),
            ("Ana B", "Voile", 61, 250, None)]
    df = spark.createDataFrame(rows, "n string, s string, m long, d long, c string")
    got = [r[0] for r in df.select(X.message_text(F.col("n"), F.col("s"), F.col("m"), F.col("d"),
                                                  F.col("c"))).collect()]
    assert got == [_expected_message(*r) for r in rows]


def test_expected_distance_range(spark):
    df = spark.createDataFrame([("Triathlon",), ("Natation",), ("Runing",), ("Tennis",), ("Vélo",)],
                               "s string")
    exp, lo, hi = X.expected_distance_range("s")
    got = [tuple(r) for r in df.select(exp, lo, hi).collect()]
    assert got == [(True, 20000, 120000), (True, 500, 5000), (True, 1000, 17500),
                   (False, None, None), (True, 1000, 20000)]


def test_meters_to_km_exact():
    assert math.isclose(round(12345 / 1000.0, 3), 12.345)


def test_cluster_settings_scale_with_input():
    from strivelake.session import cluster_settings
    small = cluster_settings(10 * 1024 ** 3)
    big = cluster_settings(100 * 1024 ** 4)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_message_with_null_sport_uses_default_label(spark):
    df = spark.createDataFrame([("Ana B", None, 5, None, None)], "n string, s string, m long, d long, c string")
    got = df.select(X.message_text(F.col("n"), F.col("s"), F.col("m"), F.col("d"), F.col("c"))).first()[0]
    assert got == "Bravo Ana B, tu viens de finir ton activité de sport qui t'a pris 5 min ! 🔥"
