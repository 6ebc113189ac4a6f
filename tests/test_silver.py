import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplake.operators.quality import leaf_fields, removed_fields
from shoplake.plans import silver
from shoplake.schemas import RECORDS, TABLES

AS_OF = dt.date(2025, 1, 1)
RUN_TS = dt.datetime(2025, 1, 1, 6)


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


def types_of(name):
    return sorted(
        (f.name, f.dataType.simpleString())
        for f in T.StructType.fromDDL(TABLES[name])
    )


def frame_types(df):
    return sorted((f.name, f.dataType.simpleString()) for f in df.schema)


@pytest.mark.parametrize("layout", ["documents", "lines"])
def test_products_are_cleaned(raw, samples, layout):
    found = silver.products(raw("products", [samples["products"]], layout), RUN_TS)
    assert frame_types(found) == types_of("products")
    row = found.first().asDict()
    assert row == {
        "id": 1,
        "title": "Lamp",
        "description": "A lamp",
        "category": "home",
        "price": 10.5,
        "discount_percentage": 5.0,
        "rating": 4.5,
        "stock": 7,
        "brand": "Acme",
        "availability_status": "in stock",
        "sku": "S-1",
        "weight": 2.0,
        "silver_processed_at": RUN_TS,
        "source_layer": "bronze",
    }


def test_missing_product_values_are_filled(raw, samples):
    base = samples["products"]
    missing = dict.fromkeys(["rating", "stock", "discountPercentage", "weight"])
    found = silver.products(
        raw(
            "products",
            [
                base | missing | {"brand": None},
                base | {"id": 2, "brand": ""},
                base | {"id": 3, "brand": "   "},
            ],
        )
    ).orderBy("id")
    assert [r.brand for r in found.collect()] == ["unknown"] * 3
    row = found.first()
    assert (row.rating, row.stock, row.discount_percentage, row.weight) == (0.0, 0, 0.0, 0.0)


def test_invalid_products_are_dropped(raw, samples):
    base = samples["products"]
    changes = [
        {"id": None},
        {"id": "x"},
        {"id": "11"},
        {"id": 12, "price": 0},
        {"id": 13, "price": -1},
        {"id": 14, "price": None},
        {"id": 15, "price": "1.5"},
        {"id": 16, "price": "cheap"},
        {"id": 17, "rating": 5},
        {"id": 18, "rating": 5.1},
        {"id": 19, "stock": -1},
        {"id": 20, "stock": 0},
        {"id": 21, "discountPercentage": 0},
        {"id": 22, "discountPercentage": 100},
        {"id": 23, "discountPercentage": 100.1},
        {"id": 24},
        {"id": 24},
    ]
    found = silver.products(raw("products", [base | change for change in changes]))
    assert ids(found) == [11, 15, 17, 20, 21, 22, 24]


def test_users_are_flattened_without_sensitive_fields(raw, samples):
    records = raw("users", [samples["users"]])
    found = silver.users(records, AS_OF, RUN_TS)
    assert frame_types(found) == types_of("users")
    row = found.first()
    assert (row.first_name, row.email, row.gender, row.role) == (
        "Ada",
        "ada@example.com",
        "female",
        "admin",
    )
    assert (row.address_country, row.address_city, row.address_lat) == ("Chile", "Town", -1.5)
    assert (row.birth_date, row.age_derived, row.age) == (dt.date(1996, 5, 30), 28, 28)
    assert (row.company_department, row.bank_card_expire) == ("Dept", "01/29")

    secret = "password ssn ein ip macAddress userAgent crypto image cardNumber iban".split()
    assert not set(secret) & set(found.columns)
    values = {str(v) for v in row}
    assert not values & {"secret", "4111", "XX1", "10.0.0.1", "i.png"}
    removed = removed_fields(records, list(silver.USER_FIELDS.values()))
    assert {r.field: r.records for r in removed.collect()} == {
        **dict.fromkeys(secret[:8], 1),
        "bank.cardNumber": 1,
        "bank.iban": 1,
    }


def test_user_fields_all_exist():
    assert set(silver.USER_FIELDS.values()) <= set(leaf_fields(RECORDS["users"]))


def test_invalid_users_are_dropped(raw, samples):
    base = samples["users"]
    changes = [
        {"id": None},
        {"id": 2, "email": "nobody"},
        {"id": 3, "email": None},
        {"id": 4, "gender": "MALE "},
        {"id": 5, "gender": "unknown"},
        {"id": 6, "gender": None},
        {"id": 7, "birthDate": "1996-13-40"},
        {"id": 8, "birthDate": None},
        {"id": 9, "birthDate": "2000-2-29"},
        {"id": 10, "birthDate": "2009-1-2"},
        {"id": 11, "birthDate": "2009-1-1"},
        {"id": 12, "birthDate": "1925-1-1"},
        {"id": 13, "birthDate": "1924-1-1"},
        {"id": 14, "age": 5},
        {"id": 15, "address": None, "company": None, "bank": None, "hair": None},
        {"id": 16},
        {"id": 16, "email": "other@example.com"},
    ]
    found = silver.users(raw("users", [base | change for change in changes]), AS_OF)
    assert ids(found) == [4, 9, 11, 12, 14, 15, 16]
    assert found.filter("id = 15").first().address_country is None
    assert found.filter("id = 9").first().age_derived == 24


def test_an_invalid_copy_may_displace_a_valid_one(raw, samples):
    base = samples["users"]
    # The copy kept is the smaller one: null sorts first.
    found = silver.users(raw("users", [base, base | {"email": None}]), AS_OF)
    assert found.count() == 0


def test_cart_summary(raw, samples, rows):
    base = samples["carts"]
    changes = [
        {},
        {"id": 2, "total": 0, "discountedTotal": 0},
        {"id": 3, "total": -1},
        {"id": 4, "totalProducts": 0},
        {"id": 5, "userId": None},
        {"id": None},
        {"id": 6, "products": []},
        {"id": 7, "products": None},
        {"id": 8, "total": 30, "discountedTotal": 20},
        {"id": 8, "total": 30, "discountedTotal": 20},
        {"id": 9, "total": None},
    ]
    found = silver.cart_summary(raw("carts", [base | change for change in changes]), RUN_TS)
    assert frame_types(found) == types_of("cart_summary")
    assert rows(found, "cart_id", "total_savings", "discount_rate") == [
        (1, 2.0, 10.0),
        (2, 0.0, None),
        (6, 2.0, 10.0),
        (7, 2.0, 10.0),
        (8, 10.0, 33.33),
    ]


def test_cart_items(raw, samples, rows):
    line, cart = samples["line"], samples["carts"]
    changes = [
        {},
        {"id": 2, "quantity": 0},
        {"id": 3, "price": 0},
        {"id": 4, "discountPercentage": 101},
        {"id": 5, "total": 20.0005},
        {"id": 6, "total": 20.01},
        {"id": 7, "quantity": 3},
        {"id": 7, "quantity": 2},
        {"id": None},
        {"id": 8, "quantity": "many"},
    ]
    carts = [
        cart | {"products": [line | change for change in changes]},
        cart | {"id": 2, "products": []},
        cart | {"id": 3, "products": None},
        cart | {"id": 4, "total": -5},
        cart | {"id": 5, "userId": None},
        cart | {"id": None},
    ]
    found = silver.cart_items(raw("carts", carts), RUN_TS)
    assert frame_types(found) == types_of("cart_items")
    assert rows(found, "cart_id", "user_id", "product_id", "quantity", "line_total_discrepancy") == [
        (1, 1, 1, 2, 0.0),
        (1, 1, 5, 2, 0.0005),
        (1, 1, 6, 2, 0.01),
        (1, 1, 7, 2, 0.0),
        (4, 1, 1, 2, 0.0),  # lines of rejected carts stay
        (5, None, 1, 2, 0.0),
    ]


def test_builder_and_assessed_form_keep_the_same_rows(raw, samples, rows):
    base = samples["products"]
    changes = [{}, {"price": 3}, {"id": 2, "stock": -1}, {"id": 3}, {"id": None}, {"id": None}]
    records = raw("products", [base | change for change in changes])
    cleaned = silver.clean_products(records)
    plain = silver.PRODUCTS.build(cleaned, RUN_TS)
    assessed = silver.PRODUCTS.assess(cleaned)
    assert rows(plain) == rows(silver.PRODUCTS.accept(assessed, cleaned, RUN_TS))
    assert assessed.agg(F.sum("copies")).first()[0] == len(changes)


def test_columns_that_follow_from_others_are_not_moved(raw, samples):
    for build in (silver.cart_items, silver.cart_summary):
        plan = build(raw("carts", [samples["carts"]]), RUN_TS)._jdf.queryExecution().executedPlan().toString()
        first = plan.index("Window [")
        for name in ("line_total_discrepancy", "discount_rate"):
            assert name not in plan[first:]
