import pytest

from strivelake.rules import DEFAULT_RULES, MARCHE, Rules, load_rules


def test_load_rules_from_yaml(tmp_path):
    p = tmp_path / "rules.yml"
    p.write_text('office_address: "x"\ngold:\n  prime_rate: 0.07\n  min_activities_for_wellbeing: 10\n'
                 '  wellbeing_days: 3\n  sportive_commute_modes:\n    - "Marche/running"\n'
                 '  exclude_commute_anomaly: false\n', encoding="utf-8")
    r = load_rules(str(p))
    assert r == Rules(prime_rate=0.07, min_activities_for_wellbeing=10, wellbeing_days=3,
                      sportive_commute_modes=(MARCHE,), exclude_commute_anomaly=False)


def test_missing_file_or_section_keeps_defaults(tmp_path):
    assert load_rules(None) == DEFAULT_RULES
    with pytest.warns(UserWarning, match="default rules apply"):
        assert load_rules(str(tmp_path / "nope.yml")) == DEFAULT_RULES
    p = tmp_path / "r.yml"
    p.write_text("other: 1\n", encoding="utf-8")
    assert load_rules(str(p)) == DEFAULT_RULES
    assert DEFAULT_RULES.min_activities_for_wellbeing == 15 and DEFAULT_RULES.prime_rate == 0.05
