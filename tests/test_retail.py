"""Retail questions on a few hand-made rows, where every answer can be seen."""

import datetime as dt
from decimal import Decimal

import pytest

from tidemart.plans import retail_basic, retail_nested, retail_ranked  # noqa: F401
from tidemart.plans.retail import QUESTIONS, Retail
from tidemart.plans.retail_basic import pairs_led_by
from tidemart.sources.relational import literal_table

D, M = dt.date, Decimal

CUSTOMERS = [
    (1, "Ada", "Odhiambo", "a@x", "1", D(2023, 1, 1), "Gold"),
    (2, "Ben", "Mwangi", "b@x", "2", D(2023, 6, 1), "Silver"),
    (3, "Cy", "Kamau", "c@x", "3", D(2024, 1, 1), "Gold"),
    (4, "Di", None, "d@x", "4", D(2020, 1, 1), "Bronze"),
    (10, "Eve", "Njeri", "e@x", "5", D(2023, 2, 1), "Gold"),
]
PRODUCTS = [
    (1, "Laptop", "Electronics", M("1200.00"), "S", 4),
    (2, "Smartphone", "Electronics", M("800.00"), "S", 150),
    (3, "Phone Case", "Accessories", M("20.00"), "T", 3),
    (4, "Fridge", "Appliances", M("1200.00"), "T", 0),
    (5, "Lamp", "Appliances", M("300.00"), "T", 60),
]
SALES = [
    (1, 1, 1, 1, D(2023, 1, 5), M("1200.00")),
    (2, 1, 2, 2, D(2023, 12, 20), M("1600.00")),
    (3, 2, 3, 8, D(2024, 1, 10), M("160.00")),
    (4, 1, 2, 1, D(2024, 1, 10), M("800.00")),
    (5, 10, 3, 1, D(2023, 2, 9), M("20.00")),
    (6, 2, 1, 1, D(2023, 12, 31), M("1200.00")),
]
INVENTORY = [(p[0], p[5]) for p in PRODUCTS]


@pytest.fixture(scope="module")
def shop(spark):
    return Retail(**{
        "customers": literal_table(spark, "customers", CUSTOMERS),
        "products": literal_table(spark, "products", PRODUCTS),
        "sales": literal_table(spark, "sales", SALES),
        "inventory": literal_table(spark, "inventory", INVENTORY),
    })


ANSWERS = {
    "q002": [(5,)],
    "q003": [("Fridge", M("1200.00")), ("Laptop", M("1200.00")), ("Smartphone", M("800.00"))],
    "q004": [(M("704.000000"),)],
    "q005": [(M("4980.00"),)],
    "q007": [("Ada Odhiambo",), ("Ben Mwangi",), ("Cy Kamau",), ("Di ",), ("Eve Njeri",)],
    "q010": [(1, 2), (2, 2), (3, 2)],
    "q013": [(1, "Ada", "Odhiambo"), (2, "Ben", "Mwangi")],
    "q015": [(1, "Ada", "Odhiambo", M("3600.00")), (2, "Ben", "Mwangi", M("1360.00")), (10, "Eve", "Njeri", M("20.00"))],
    "q017": [(1, "Ada", "Gold", 1, 2), (2, "Ben", "Silver", 1, 0), (3, "Cy", "Gold", 2, 1), (4, "Di", "Bronze", 1, 0), (10, "Eve", "Gold", 3, 0)],
    "q020": [("Phone Case", 9)],
    "q021": [(1, "Ada"), (2, "Ben")],
    "q023": [(1, "Ada"), (1, "Ada"), (2, "Ben"), (10, "Eve")],
    "q024": [(1, "Ada", M("2800.00"))],
    "q025": [("Laptop", M("1200.00"))],
    "q026": [(4,)],
    "q026_intent": [(2,)],
    "q027": [(4,)],
    "q028": [("Fridge", 0), ("Laptop", 4), ("Phone Case", 3)],
    "q031": [(2,)],
    "q033": [("Laptop", 4), ("Phone Case", 3)],
    "q035": [(1, "Ada", D(2023, 1, 1), D(2023, 1, 5))],
    "q039": [(2, "Smartphone", 150, "highest"), (4, "Fridge", 0, "lowest")],
    "q040": [("Phone Case", M("180.00"))],
    "q041": [("Ada", "Gold", "Laptop", M("1200.00")), ("Ada", "Gold", "Smartphone", M("2400.00")), ("Eve", "Gold", "Phone Case", M("20.00"))],
    "q046": [(3,)],
    "q053": [(3, "Cy"), (4, "Di")],
    "q054": [(4, "Fridge"), (5, "Lamp")],
    "q055": [(1, "Ada", M("1600.00"))],
    "q058": [(1, "Laptop", "Electronics", M("1200.00")), (4, "Fridge", "Appliances", M("1200.00"))],
    "q059": [(1, "Ada", M("800.00")), (1, "Ada", M("1200.00")), (1, "Ada", M("1600.00")), (2, "Ben", M("160.00")), (2, "Ben", M("1200.00"))],
    "q059_intent": [(1, "Ada", M("3600.00")), (2, "Ben", M("1360.00"))],
    "q064": [(1, "Ada", 3), (2, "Ben", 2)],
    "q069": [],
    "q071": [(1, "Ada", M("800.00"), 4), (1, "Ada", M("1200.00"), 2), (1, "Ada", M("1600.00"), 1), (2, "Ben", M("160.00"), 5), (2, "Ben", M("1200.00"), 2), (10, "Eve", M("20.00"), 6)],
    "q073": [],
    "q073_intent": [(10, "Eve", M("20.00"), 3)],
    "q074": [],
    "q075": [(1, "Laptop", "Electronics", M("1200.00"), 1), (2, "Smartphone", "Electronics", M("800.00"), 2), (3, "Phone Case", "Accessories", M("20.00"), 1), (4, "Fridge", "Appliances", M("1200.00"), 1), (5, "Lamp", "Appliances", M("300.00"), 2)],
    "q077": [(1, D(2023, 1, 5), M("4980.00")), (2, D(2023, 12, 20), M("3760.00")), (3, D(2024, 1, 10), M("960.00")), (4, D(2024, 1, 10), M("960.00")), (5, D(2023, 2, 9), M("3780.00")), (6, D(2023, 12, 31), M("2160.00"))],
    "q077_intent": [(1, D(2023, 1, 5), M("1200.00")), (2, D(2023, 12, 20), M("2820.00")), (3, D(2024, 1, 10), M("4980.00")), (4, D(2024, 1, 10), M("4980.00")), (5, D(2023, 2, 9), M("1220.00")), (6, D(2023, 12, 31), M("4020.00"))],
    "q078": [(1, D(2023, 1, 5), M("1200.00"), None), (2, D(2023, 12, 20), M("1600.00"), M("20.00")), (3, D(2024, 1, 10), M("160.00"), M("1200.00")), (4, D(2024, 1, 10), M("800.00"), M("160.00")), (5, D(2023, 2, 9), M("20.00"), M("1200.00")), (6, D(2023, 12, 31), M("1200.00"), M("1600.00"))],
    "q080": [(1, "Ada", "Odhiambo", M("3600.00"), 1), (2, "Ben", "Mwangi", M("1360.00"), 2), (10, "Eve", "Njeri", M("20.00"), 3)],
    "q081": [],
    "q081_intent": [(2, "Ben", 2)],
    "q084": [(1, "Ada", "Odhiambo", "Smartphone", 2)],
    "q087": [(1, "Ada", "Odhiambo"), (2, "Ben", "Mwangi")],
    "q090": [(2, "Ben", "Mwangi", 9)],
    "q091": [(1, "Ada", "Odhiambo", M("3600.00"))],
    "q092": [("Laptop", M("2400.00")), ("Smartphone", M("2400.00"))],
    "q093": [(1, "Ada", "Odhiambo"), (2, "Ben", "Mwangi")],
    "q094": [("Fridge", 0, 0, 0), ("Lamp", 60, 0, 60), ("Laptop", 4, 2, 2), ("Phone Case", 3, 9, -6), ("Smartphone", 150, 3, 147)],
    "q097": [(10, "Eve", "Njeri", M("20.00"), M("20.00"), M("100.00"))],
    "q099": [(1, "Ada", "Odhiambo", M("3600.00"))],
    "q100": [("Phone Case",), ("Smartphone",)],
}


@pytest.mark.parametrize("name", sorted(ANSWERS))
def test_answer(shop, rows, name):
    assert rows(QUESTIONS[name](shop)) == sorted(ANSWERS[name], key=lambda r: tuple((v is not None, v) for v in r))


def test_clock_dependent_question(shop, rows):
    q = QUESTIONS["q047"]
    assert rows(q(shop, as_of=D(2024, 6, 1))) == [("Fridge",), ("Lamp",)]
    assert rows(q(shop, as_of=D(2024, 7, 11))) == [(p[1],) for p in sorted(PRODUCTS, key=lambda p: p[1])]


def test_pairs_from_their_linear_form(shop, rows):
    encoded = QUESTIONS["q017"](shop, rows_per_slice=2)
    listed = [p for c in CUSTOMERS for p in rows(pairs_led_by(encoded, c[0]))]
    expected = [
        (a[0], a[1], b[0], b[1], a[6]) for a in CUSTOMERS for b in CUSTOMERS if a[6] == b[6] and a[0] < b[0]
    ]
    assert sorted(listed) == sorted(expected)


def test_null_reference_empties_not_in(spark, shop, rows):
    broken = literal_table(spark, "sales", [*SALES, (7, None, None, 1, D(2024, 1, 1), M("1"))])
    assert rows(QUESTIONS["q053"](Retail(shop.customers, shop.products, broken, shop.inventory))) == []
    assert rows(QUESTIONS["q054"](Retail(shop.customers, shop.products, broken, shop.inventory))) == []
