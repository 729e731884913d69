"""The 20-row toy career case of FIXTURES.md §4 and its expected outputs."""

from stintwise.schemas import APPEARANCES

T, F_ = True, False
TOY_ROWS = [
    (2018, "eA", "A", "d1", T, F_), (2019, "eA", "A", "d1", T, F_), (2019, "eB", "B", "d1", T, F_),
    (2020, "eB", "B", "d1", T, F_), (2023, "eC", "C", "d1", T, F_), (2024, "eC", "C", "d1", T, F_),
    (2025, "eC", "C", "d1", F_, F_), (2018, "eA", "A", "d2", T, F_), (2019, "eA", "A", "d2", T, F_),
    (2018, "eB", "B", "d3", F_, T), (2020, "eB", "B", "d3", T, F_), (2021, "eD", "D", "d3", T, F_),
    (2024, "eD", "D", "d3", T, F_), (2019, "eA", "A", "d4", T, F_), (2019, "eB", "B", "d4", T, F_),
    (2019, "eC", "C", "d4", F_, T), (2024, "eB", "B", "d4", T, F_), (2025, "eB", "B", "d4", F_, F_),
    (2022, "eC", "C", "d5", T, F_), (2025, "eA", "A", "d5", F_, F_),
]

EXPECTED = {
    "debuts": {("d1", "A", 2018), ("d2", "A", 2018), ("d3", "B", 2020), ("d4", "A", 2019),
               ("d4", "B", 2019), ("d4", "C", 2019), ("d5", "C", 2022)},
    "last_seen_before_max": {(2019, "d2"), (2022, "d5"), (2024, "d1"), (2024, "d3"), (2024, "d4")},
    "retirements_announced": {("d2", "A", 2019), ("d3", "D", 2024), ("d5", "C", 2022)},
    "transfers_consecutive": {("d3", "B", 2020, "D", 2021)},
    "transfers_with_midseason": {("d1", "A", 2019, "B", 2019), ("d3", "B", 2020, "D", 2021),
                                 ("d4", "A", 2019, "B", 2019)},
    "gap_pairs": {("d1", "A", 2019, "C", 2023, 4), ("d1", "B", 2020, "C", 2023, 3)},
    "gaps_unexplained": {("d1", "A", 2019, "C", 2023, 4), ("d1", "B", 2020, "C", 2023, 3)},
    "breaks": {("d1", "B", 2020, "C", 2023, 3)},
}


def toy_appearances(spark):
    return spark.createDataFrame(TOY_ROWS, APPEARANCES)
