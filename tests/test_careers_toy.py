import pytest

from stintwise.operators import careers
from tests.fixtures import EXPECTED


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", ["debuts", "last_seen_before_max", "retirements_announced",
                                  "transfers_consecutive", "transfers_with_midseason",
                                  "gap_pairs"])
def test_toy_relation(toy, name):
    got = rows(getattr(careers, name)(toy))
    assert len(got) == len(set(got))
    assert set(got) == EXPECTED[name]


@pytest.mark.parametrize("midseason", [False, True])
def test_toy_breaks(toy, midseason):
    assert set(rows(careers.gaps_unexplained(toy, midseason))) == EXPECTED["gaps_unexplained"]
    assert set(rows(careers.breaks(toy, midseason))) == EXPECTED["breaks"]


def test_debut_years(toy):
    got = set(rows(careers.debut_years(toy)))
    assert got == {(2018, "d1"), (2018, "d2"), (2020, "d3"), (2019, "d4"), (2022, "d5")}


def test_transfers_of_driver(toy):
    assert set(rows(careers.transfers_of_driver(toy, "d1"))) == {("d1", "A", 2019, "B", 2019)}


def test_debuts_from_shared_spans(toy):
    assert set(rows(careers.debuts(toy, careers.shared_spans(toy)))) == EXPECTED["debuts"]


@pytest.mark.parametrize("name", ["debuts", "retirements_announced", "transfers_with_midseason", "gap_pairs", "breaks"])
def test_own_column_names(toy, name):
    own = toy.selectExpr("driverId AS person", "constructorId AS team", "year AS season", "tookPart AS played",
                         "'x' AS driverId", "testDriver AS year")
    got = careers.with_names(getattr(careers, name), own, entity="person", group="team", period="season", active="played")
    assert got.columns[0] == "person" and "driverId" not in got.columns
    assert set(rows(got)) == EXPECTED[name]


def test_own_column_names_pass_arguments(toy):
    own = toy.withColumnRenamed("driverId", "person")
    assert rows(careers.with_names(careers.transfers_of_driver, own, "d1", entity="person")) == [("d1", "A", 2019, "B", 2019)]
