from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from logweir import CountryRule, read_rules, standardise_country
from logweir.operators.countries import standard_name, unmapped_names
from logweir.schemas import COUNTRY_MAPPING

RULES = [
    CountryRule(2, "korea", "Korea"),
    CountryRule(1, "north.*korea|korea.*north", "North Korea"),
    CountryRule(3, r"^(the )?netherlands", "Netherlands"),
    CountryRule(4, "türki", "Türkiye"),
]


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "country_name string")


def mapping(spark, *pairs):
    return spark.createDataFrame(list(pairs), COUNTRY_MAPPING)


def pairs_of(df):
    return sorted((r.raw_country_name, r.cleaned_country_name) for r in df.collect())


def test_standard_names(spark):
    logs = names(spark, "Old Name", "Netherlands (Kingdom of the)", "Atlantis", None, "North Korea",
                 "KOREA (REPUBLIC OF)", "TÜRKIYE")
    result, grown = standardise_country(logs, mapping(spark, ("Old Name", "By Hand")), RULES)
    assert sorted(r.country_name or "" for r in result.collect()) == sorted(
        ["By Hand", "Netherlands", "not found", "", "North Korea", "Korea", "Türkiye"]
    )
    assert ("Old Name", "By Hand") in pairs_of(grown)
    assert len(pairs_of(grown)) == 6 and None not in [raw for raw, _ in pairs_of(grown)]


def test_unmatched_names_can_be_kept(spark):
    result, _ = standardise_country(names(spark, "Atlantis"), mapping(spark), RULES, unmatched="keep")
    assert result.first().country_name == "Atlantis"
    with pytest.raises(ValueError):
        standard_name(F.col("x"), RULES, "drop")


def test_second_run_changes_nothing(spark):
    logs = names(spark, "North Korea", "Atlantis", None, None)
    saved = []

    def save(table):
        saved.append(pairs_of(table))
        return table

    first, grown = standardise_country(logs, mapping(spark), RULES, save=save)
    second, again = standardise_country(logs, grown, RULES, save=save)
    assert len(saved) == 1
    assert pairs_of(again) == pairs_of(grown)
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))


def test_edited_names_win_over_rules(spark):
    result, _ = standardise_country(
        names(spark, "North Korea"), mapping(spark, ("North Korea", "DPRK")), RULES
    )
    assert result.first().country_name == "DPRK"


def test_mapped_name_may_be_null(spark):
    result, _ = standardise_country(names(spark, "X"), mapping(spark, ("X", None)), RULES)
    assert result.first().country_name == "X"


def test_nulls_are_never_unmapped(spark):
    assert unmapped_names(names(spark, None, None), mapping(spark)).isEmpty()


def test_columns_keep_their_places(spark):
    table = names(spark, "X").select(F.lit(1).alias("a"), "country_name", F.lit(2).alias("b"))
    result, _ = standardise_country(table, mapping(spark), RULES, limit=0)
    assert result.columns == ["a", "country_name", "b"]


def test_mapping_needs_its_columns(spark):
    with pytest.raises(ValueError, match="cleaned_country_name"):
        standardise_country(names(spark, "X"), names(spark, "X"), RULES)


def test_other_country_column(spark):
    table = names(spark, "korea").withColumnRenamed("country_name", "land")
    result, _ = standardise_country(table, mapping(spark), RULES, country_col="land")
    assert result.first().land == "Korea"


def test_rules_from_a_file(tmp_path):
    path = tmp_path / "rules.csv"
    path.write_text("priority,pattern,standard_name\n1,\"^a,b\",A\n2,^c,C\n", encoding="utf-8")
    assert read_rules(str(path)) == [CountryRule(1, "^a,b", "A"), CountryRule(2, "^c", "C")]
