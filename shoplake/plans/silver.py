"""Raw records to typed, cleaned, deduplicated and validated tables.

Each table comes in two forms that keep the same rows: a plain ``DataFrame`` builder, and
the ``SilverTable`` that the pipeline uses to count drops while it writes.
"""

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.functions import age_on, clean, clean_lower, or_unknown, real, whole
from shoplake.functions.numbers import in_range
from shoplake.operators.dedup import without_copies, without_copies_late
from shoplake.operators.nested import explode_keeping
from shoplake.operators.quality import accepted, assess
from shoplake.operators.rules import Rules, passing

# Genders the user rules accept.
GENDERS = ("male", "female", "other")

# The raw product fields that go on, and the names of raw fields in clean tables.
PRODUCT_FIELDS = [
    "id",
    "title",
    "description",
    "category",
    "price",
    "discountPercentage",
    "rating",
    "stock",
    "brand",
    "availabilityStatus",
    "sku",
    "weight",
]
PRODUCT_NAMES = {
    "discountPercentage": "discount_percentage",
    "availabilityStatus": "availability_status",
}
# The only raw user fields that go on, by the name they end up under.
USER_FIELDS = {
    "id": "id",
    "first_name": "firstName",
    "last_name": "lastName",
    "age": "age",
    "gender": "gender",
    "email": "email",
    "phone": "phone",
    "username": "username",
    "birth_date": "birthDate",
    "blood_group": "bloodGroup",
    "height": "height",
    "weight": "weight",
    "eye_color": "eyeColor",
    "hair_color": "hair.color",
    "hair_type": "hair.type",
    "address_street": "address.address",
    "address_city": "address.city",
    "address_state": "address.state",
    "address_state_code": "address.stateCode",
    "address_postal_code": "address.postalCode",
    "address_country": "address.country",
    "address_lat": "address.coordinates.lat",
    "address_lng": "address.coordinates.lng",
    "university": "university",
    "role": "role",
    "company_name": "company.name",
    "company_department": "company.department",
    "company_title": "company.title",
    "bank_card_type": "bank.cardType",
    "bank_currency": "bank.currency",
    "bank_card_expire": "bank.cardExpire",
}


def with_audit(df: DataFrame, layer: str, run_ts: dt.datetime | None, source: str) -> DataFrame:
    """Processing time (one value per run if given) and the layer the rows came from."""
    moment = F.current_timestamp() if run_ts is None else F.lit(run_ts)
    return df.withColumns({f"{layer}_processed_at": moment, "source_layer": F.lit(source)})


# --- products ---------------------------------------------------------------------------


def select_products(raw: DataFrame) -> DataFrame:
    return raw.select(*PRODUCT_FIELDS).withColumnsRenamed(PRODUCT_NAMES)


def type_products(raw: DataFrame) -> DataFrame:
    return select_products(raw).withColumns(
        {
            "id": whole("id", "bigint"),
            "price": real("price"),
            "discount_percentage": real("discount_percentage"),
            "rating": real("rating"),
            "stock": whole("stock"),
            "weight": real("weight"),
            "title": clean("title"),
            "brand": clean("brand"),
            "category": clean_lower("category"),
            "availability_status": clean_lower("availability_status"),
            "sku": clean("sku"),
        }
    )


def clean_products(raw: DataFrame) -> DataFrame:
    return (
        type_products(raw)
        .withColumn("brand", or_unknown(F.col("brand")))
        .fillna({"rating": 0.0, "stock": 0, "discount_percentage": 0.0, "weight": 0.0})
    )


def product_rules() -> Rules:
    return {
        "id_present": F.col("id").isNotNull(),
        "price_positive": F.col("price") > 0,
        "rating_0_to_5": F.col("rating").between(0, 5),
        "stock_not_negative": F.col("stock") >= 0,
        "discount_0_to_100": F.col("discount_percentage").between(0, 100),
        "amounts_in_range": in_range("price"),
    }


# --- users ------------------------------------------------------------------------------


def flatten_users(raw: DataFrame) -> DataFrame:
    """Structs to prefixed columns; fields outside the allow-list do not come along."""
    return raw.select(*[F.col(path).alias(name) for name, path in USER_FIELDS.items()])


def clean_users(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    typed = flatten_users(raw).withColumns(
        {
            "id": whole("id", "bigint"),
            "age": whole("age"),
            "height": real("height"),
            "weight": real("weight"),
            "address_lat": real("address_lat"),
            "address_lng": real("address_lng"),
            "birth_date": F.try_to_date("birth_date", "yyyy-M-d"),
            **{
                name: clean(name)
                for name in (
                    "first_name last_name address_city address_country company_name "
                    "company_department"
                ).split()
            },
            **{name: clean_lower(name) for name in ("email", "gender", "role")},
        }
    )
    return typed.withColumn("age_derived", age_on(as_of, F.col("birth_date")))


def user_rules() -> Rules:
    return {
        "id_present": F.col("id").isNotNull(),
        "email_has_at": F.col("email").isNotNull() & F.col("email").contains("@"),
        "age_16_to_100": F.col("age_derived").between(16, 100),
        "gender_known": F.col("gender").isin(*GENDERS),
    }


# --- carts ------------------------------------------------------------------------------


def type_cart_summary(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("id", "bigint").alias("cart_id"),
        whole("userId", "bigint").alias("user_id"),
        whole("totalProducts").alias("total_products"),
        whole("totalQuantity").alias("total_quantity"),
        real("total").alias("cart_total"),
        real("discountedTotal").alias("cart_discounted_total"),
    )


def with_savings(typed: DataFrame) -> DataFrame:
    saved = F.col("cart_total") - F.col("cart_discounted_total")
    return typed.withColumns(
        {
            "total_savings": F.round(saved, 2),
            "discount_rate": F.round(F.try_divide(saved, F.col("cart_total")) * 100, 2),
        }
    )


def clean_cart_summary(raw: DataFrame) -> DataFrame:
    return with_savings(type_cart_summary(raw))


def cart_summary_rules() -> Rules:
    return {
        "cart_id_present": F.col("cart_id").isNotNull(),
        "user_id_present": F.col("user_id").isNotNull(),
        "total_not_negative": F.col("cart_total") >= 0,
        "has_products": F.col("total_products") > 0,
        "amounts_in_range": in_range("cart_total", "cart_discounted_total"),
    }


def explode_carts(raw: DataFrame) -> DataFrame:
    """One row per line of a cart; carts without lines disappear."""
    parents = [F.col("id").alias("cart_id"), F.col("userId").alias("user_id")]
    return explode_keeping(raw, parents, "products", "item").select(
        "cart_id", "user_id", "item.*"
    )


def type_cart_items(raw: DataFrame) -> DataFrame:
    return explode_carts(raw).select(
        whole("cart_id", "bigint").alias("cart_id"),
        whole("user_id", "bigint").alias("user_id"),
        whole("id", "bigint").alias("product_id"),
        clean("title").alias("product_title"),
        real("price").alias("unit_price"),
        whole("quantity").alias("quantity"),
        real("total").alias("line_total"),
        real("discountPercentage").alias("discount_percentage"),
        real("discountedTotal").alias("line_discounted_total"),
    )


def with_recomputed(typed: DataFrame) -> DataFrame:
    recomputed = F.round(F.col("unit_price") * F.col("quantity"), 2)
    return typed.withColumns(
        {
            "line_total_recomputed": recomputed,
            "line_total_discrepancy": F.round(F.col("line_total") - recomputed, 4),
        }
    )


def clean_cart_items(raw: DataFrame) -> DataFrame:
    return with_recomputed(type_cart_items(raw))


def cart_item_rules() -> Rules:
    return {
        "cart_id_present": F.col("cart_id").isNotNull(),
        "product_id_present": F.col("product_id").isNotNull(),
        "quantity_positive": F.col("quantity") > 0,
        "price_positive": F.col("unit_price") > 0,
        "discount_0_to_100": F.col("discount_percentage").between(0, 100),
        "amounts_in_range": in_range("unit_price", "line_total", "line_discounted_total"),
    }


# --- tables -----------------------------------------------------------------------------


@dataclass(frozen=True)
class SilverTable:
    name: str
    entity: str
    keys: tuple[str, ...]
    clean: Callable[..., DataFrame]
    rules: Callable[[], dict[str, Column]]
    watched: tuple[str, ...] = ()
    # What ``clean`` does as two steps, the second of which adds columns on the right that follow
    # from the others: they don't decide which copy is kept, no rule looks at them, and so they
    # need not be moved.
    typed: Callable[[DataFrame], DataFrame] | None = None
    derived: Callable[[DataFrame], DataFrame] | None = None

    def build(
        self, cleaned: DataFrame, run_ts: dt.datetime | None = None, late: bool = False
    ) -> DataFrame:
        """Duplicates go first, then invalid rows: an invalid copy may displace a valid one.
        Typed rows will do where ``derived`` adds the other columns: it comes last.

        ``late`` finds repeated keys in a job of its own and moves only their rows.
        """
        first = without_copies_late if late else without_copies
        kept = first(cleaned, self.keys).filter(passing(self.rules()))
        kept = self.derived(kept) if self.derived else kept
        return with_audit(kept, "silver", run_ts, "bronze")

    def assess(self, cleaned: DataFrame) -> DataFrame:
        return assess(cleaned, self.keys, self.rules(), self.watched)

    def accept(
        self, assessed: DataFrame, cleaned: DataFrame, run_ts: dt.datetime | None = None
    ) -> DataFrame:
        return with_audit(accepted(assessed, cleaned.columns), "silver", run_ts, "bronze")


PRODUCTS = SilverTable(
    "products",
    "products",
    ("id",),
    clean_products,
    product_rules,
    ("id", "price", "rating", "stock", "category", "brand"),
)
USERS = SilverTable(
    "users",
    "users",
    ("id",),
    clean_users,
    user_rules,
    ("id", "email", "first_name", "last_name", "age", "birth_date", "gender"),
)
CART_SUMMARY = SilverTable(
    "cart_summary",
    "carts",
    ("cart_id",),
    clean_cart_summary,
    cart_summary_rules,
    typed=type_cart_summary,
    derived=with_savings,
)
CART_ITEMS = SilverTable(
    "cart_items",
    "carts",
    ("cart_id", "product_id"),
    clean_cart_items,
    cart_item_rules,
    typed=type_cart_items,
    derived=with_recomputed,
)


def products(raw: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    return PRODUCTS.build(clean_products(raw), run_ts)


def users(
    raw: DataFrame, as_of: dt.date | None = None, run_ts: dt.datetime | None = None
) -> DataFrame:
    return USERS.build(clean_users(raw, as_of), run_ts)


def cart_summary(raw: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    return CART_SUMMARY.build(type_cart_summary(raw), run_ts)


def cart_items(
    raw: DataFrame, run_ts: dt.datetime | None = None, late: bool = False
) -> DataFrame:
    return CART_ITEMS.build(type_cart_items(raw), run_ts, late)
