"""Explicit schemas.

Scalar leaves of the raw records are read as text and cast while cleaning, so that a
number which arrives once as ``1`` and once as ``"1"`` keeps its value, and a malformed one
becomes null instead of spoiling the record.
"""

from pyspark.sql import types as T


def _texts(names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names.split()]


def _nested(name: str, fields: list[T.StructField]) -> T.StructField:
    return T.StructField(name, T.StructType(fields))


PRODUCT_RECORD = T.StructType(
    _texts(
        "id title description category price discountPercentage rating stock brand "
        "availabilityStatus sku weight"
    )
)

USER_RECORD = T.StructType(
    _texts(
        "id firstName lastName age gender email phone username birthDate bloodGroup height "
        "weight eyeColor university role"
    )
    + [
        _nested("hair", _texts("color type")),
        _nested(
            "address",
            _texts("address city state stateCode postalCode country")
            + [_nested("coordinates", _texts("lat lng"))],
        ),
        _nested("company", _texts("name department title")),
        _nested("bank", _texts("cardType currency cardExpire cardNumber iban")),
    ]
    + _texts("password ssn ein ip macAddress userAgent crypto image")
)

CART_LINE = T.StructType(
    _texts("id title price quantity total discountPercentage discountedTotal")
)

CART_RECORD = T.StructType(
    _texts("id userId totalProducts totalQuantity total discountedTotal")
    + [T.StructField("products", T.ArrayType(CART_LINE))]
)

RECORDS = {"products": PRODUCT_RECORD, "users": USER_RECORD, "carts": CART_RECORD}


def document(entity: str) -> T.StructType:
    """Schema of a raw document: the records in an array under the entity's name."""
    return T.StructType([T.StructField(entity, T.ArrayType(RECORDS[entity]))])


_AUDIT = "silver_processed_at timestamp, source_layer string"
_GOLD_AUDIT = "gold_processed_at timestamp, source_layer string"

# Ids are bigint: 32-bit keys run out long before the data sizes this is meant for.
TABLES = {
    "products": f"""id bigint, title string, description string, price double,
        discount_percentage double, rating double, stock int, brand string,
        availability_status string, sku string, weight double, {_AUDIT}, category string""",
    "users": f"""id bigint, first_name string, last_name string, age int, gender string,
        email string, phone string, username string, birth_date date, blood_group string,
        height double, weight double, eye_color string, hair_color string, hair_type string,
        address_street string, address_city string, address_state string,
        address_state_code string, address_postal_code string, address_lat double,
        address_lng double, university string, role string, company_name string,
        company_department string, company_title string, bank_card_type string,
        bank_currency string, bank_card_expire string, age_derived int, {_AUDIT},
        address_country string""",
    "cart_summary": f"""cart_id bigint, user_id bigint, total_products int,
        total_quantity int, cart_total double, cart_discounted_total double,
        total_savings double, discount_rate double, {_AUDIT}""",
    "cart_items": f"""cart_id bigint, user_id bigint, product_id bigint,
        product_title string, unit_price double, quantity int, line_total double,
        discount_percentage double, line_discounted_total double,
        line_total_recomputed double, line_total_discrepancy double, {_AUDIT}""",
    "customer_360": f"""user_id bigint, first_name string, last_name string, email string,
        gender string, age int, address_city string, address_country string,
        company_department string, role string, total_carts bigint,
        total_items_bought bigint, total_spend double, avg_cart_value double,
        avg_basket_size double, favourite_category string,
        avg_discount_captured_pct double, total_savings double, {_GOLD_AUDIT}""",
    "product_performance": f"""product_id bigint, title string, brand string, sku string,
        catalogue_price double, rating double, stock int, availability_status string,
        weight double, total_units_sold bigint, times_added_to_cart bigint,
        unique_buyers bigint, total_revenue double, avg_sold_price double,
        avg_discount_pct double, price_drift double, demand_tier string, {_GOLD_AUDIT},
        category string""",
    "stock_risk": f"""product_id bigint, title string, category string, brand string,
        sku string, availability_status string, current_stock int, pending_demand bigint,
        net_stock bigint, stock_coverage_ratio double, {_GOLD_AUDIT}, risk_level string""",
}
