"""Reference results as DuckDB SQL, written against the test tables.

Rounding on the Spark side works on the shortest decimal text of a double; ``_round`` does
the same here. Sums of amounts are taken in decimal on both sides.
"""

import re

from harness.views import (
    BROKEN,
    CART,
    CART_OF_LINE,
    LINE,
    PRODUCT,
    PRODUCT_COPIES,
    SECRETS,
    USER,
    USER_COPIES,
    listing,
)

_AS_OF = "date '2025-01-01'"


def _round(value: str, digits: int) -> str:
    rounded = f"cast(round(cast(cast({value} as varchar) as decimal(38, 18)), {digits}) as double)"
    # Numbers that a decimal can't hold are whole anyway.
    return f"case when abs({value}) < 1e15 then {rounded} else {value} end"


def _finite(column: str) -> str:
    return f'case when isfinite("{column}") then "{column}" end'


def _in_range(*columns: str) -> str:
    return " and ".join(f"coalesce(abs({c}), 0) < 1e15" for c in columns)


def _total(value: str) -> str:
    return f"cast(cast(sum(cast({value} as decimal(30, 6))) as varchar) as double)"


def _sum(value: str, digits: int) -> str:
    return _round(_total(value), digits)


def _mean(value: str, digits: int) -> str:
    return _round(f"{_total(value)} / nullif(count({value}), 0)", digits)


def _units(value: str) -> str:
    return f"cast(sum({value}) as bigint)"


_PRODUCT_COLUMNS = (
    "id title description category price discount_percentage rating stock brand "
    "availability_status sku weight"
).split()

_USER_COLUMNS = {
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
_TRIMMED = "first_name last_name address_city address_country company_name company_department"
_LOWERED = "email gender role"

_SUMMARY_COLUMNS = (
    "cart_id user_id total_products total_quantity cart_total cart_discounted_total "
    "total_savings discount_rate"
).split()

_ITEM_COLUMNS = (
    "cart_id user_id product_id product_title unit_price quantity line_total "
    "discount_percentage line_discounted_total line_total_recomputed line_total_discrepancy"
).split()


def _user_value(name: str, source: str) -> str:
    column = f'"{source}"'
    if name in _TRIMMED.split():
        column = f"trim({column})"
    elif name in _LOWERED.split():
        column = f"lower(trim({column}))"
    elif name == "birth_date":
        column = f"cast(try_strptime({column}, '%Y-%m-%d') as date)"
    return f"{column} as {name}"


def _first_copy(columns: list[str], keys: list[str], source: str) -> str:
    order = ", ".join(f"{c} asc nulls first" for c in columns if c not in keys)
    return f"""select {", ".join(columns)} from (
        select *, row_number() over (partition by {", ".join(keys)} order by {order}) as place
        from {source}) where place = 1"""


_RULES = {
    "products": {
        "id_present": "id is not null",
        "price_positive": "price > 0",
        "rating_0_to_5": "rating between 0 and 5",
        "stock_not_negative": "stock >= 0",
        "discount_0_to_100": "discount_percentage between 0 and 100",
        "amounts_in_range": _in_range("price"),
    },
    "users": {
        "id_present": "id is not null",
        "email_has_at": "email like '%@%'",
        "age_16_to_100": "age_derived between 16 and 100",
        "gender_known": "gender in ('male', 'female', 'other')",
    },
    "cart_summary": {
        "cart_id_present": "cart_id is not null",
        "user_id_present": "user_id is not null",
        "total_not_negative": "cart_total >= 0",
        "has_products": "total_products > 0",
        "amounts_in_range": _in_range("cart_total", "cart_discounted_total"),
    },
    "cart_items": {
        "cart_id_present": "cart_id is not null",
        "product_id_present": "product_id is not null",
        "quantity_positive": "quantity > 0",
        "price_positive": "unit_price > 0",
        "discount_0_to_100": "discount_percentage between 0 and 100",
        "amounts_in_range": _in_range("unit_price", "line_total", "line_discounted_total"),
    },
}
_CLEAN = {
    "products": "clean_products",
    "users": "clean_users",
    "cart_summary": "clean_summary",
    "cart_items": "clean_items",
}
_DISTINCT = {
    "products": "one_product",
    "users": "one_user",
    "cart_summary": "one_summary",
    "cart_items": "one_item",
}
_WATCHED = {
    "products": "id price rating stock category brand".split(),
    "users": "id email first_name last_name age birth_date gender".split(),
    "cart_summary": [],
    "cart_items": [],
}


def _valid(table: str) -> str:
    rules = " and ".join(f"({rule})" for rule in _RULES[table].values())
    return f"select *, 'bronze' as source_layer from {_DISTINCT[table]} where {rules}"


def _failed(table: str) -> str:
    cases = " ".join(
        f"when ({rule}) is not true then '{name}'" for name, rule in _RULES[table].items()
    )
    return f"case {cases} end"


_CTES = {
    "raw_products": f"""select {listing(PRODUCT)} from (
        select *, unnest(range(1, 1 + {PRODUCT_COPIES})) as copy from part)""",
    "raw_users": f"""select {listing(USER | SECRETS)} from (
        select *, unnest(range(1, 1 + {USER_COPIES})) as copy
        from customer join nation on c_nationkey = n_nationkey)""",
    "raw_headers": f"select {listing(CART)} from orders",
    "raw_lines": f"""select o_orderkey as cart_id, {CART["userId"]} as user_id, {listing(LINE)}
        from lineitem join orders on l_orderkey = o_orderkey
        union all
        select o_orderkey, {CART["userId"]}, {listing(LINE | {"quantity": f"({LINE['quantity']}) + 1"})}
        from lineitem join orders on l_orderkey = o_orderkey where l_linenumber = 7""",
    "raw_carts": f"""select * from raw_headers
        union all select {listing(CART_OF_LINE)} from lineitem join orders on l_orderkey = o_orderkey""",
    "typed_products": f"""select id, trim(title) as title, description,
        lower(trim(category)) as category, {_finite("price")} as price, "discountPercentage" as discount_percentage,
        rating, stock, trim(brand) as brand,
        lower(trim("availabilityStatus")) as availability_status, trim(sku) as sku, weight
        from raw_products""",
    "clean_products": """select * replace (
        case when brand is null or brand = '' then 'unknown' else brand end as brand,
        coalesce(rating, 0) as rating, coalesce(stock, 0) as stock,
        coalesce(discount_percentage, 0) as discount_percentage,
        coalesce(weight, 0) as weight) from typed_products""",
    "one_product": _first_copy(_PRODUCT_COLUMNS, ["id"], "clean_products"),
    "products": _valid("products"),
    "typed_users": f"""select id,
        {", ".join(_user_value(n, s) for n, s in _USER_COLUMNS.items())} from raw_users""",
    "clean_users": f"""select *,
        cast(floor(datesub('month', birth_date, {_AS_OF}) / 12) as int) as age_derived
        from typed_users""",
    "one_user": _first_copy(["id", *_USER_COLUMNS, "age_derived"], ["id"], "clean_users"),
    "users": _valid("users"),
    "clean_summary": f"""select id as cart_id, "userId" as user_id,
        "totalProducts" as total_products, "totalQuantity" as total_quantity,
        total as cart_total, "discountedTotal" as cart_discounted_total,
        {_round('total - "discountedTotal"', 2)} as total_savings,
        {_round('(total - "discountedTotal") / nullif(total, 0) * 100', 2)} as discount_rate
        from (select * replace ({_finite("total")} as total) from raw_carts)""",
    "one_summary": _first_copy(_SUMMARY_COLUMNS, ["cart_id"], "clean_summary"),
    "cart_summary": _valid("cart_summary"),
    "clean_items": f"""select *,
        {_round("line_total - line_total_recomputed", 4)} as line_total_discrepancy
        from (select cart_id, user_id, id as product_id, trim(title) as product_title,
            price as unit_price, quantity, total as line_total,
            "discountPercentage" as discount_percentage,
            "discountedTotal" as line_discounted_total,
            {_round("price * quantity", 2)} as line_total_recomputed
            from (select * replace ({_finite("price")} as price, {_finite("total")} as total,
                {_finite("discountedTotal")} as "discountedTotal") from raw_lines))""",
    "one_item": _first_copy(_ITEM_COLUMNS, ["cart_id", "product_id"], "clean_items"),
    "cart_items": _valid("cart_items"),
    "user_carts": f"""select user_id, cart_id, sum(quantity) as cart_quantity,
        sum(cast(line_discounted_total as decimal(30, 6))) as cart_spend
        from cart_items group by user_id, cart_id""",
    "purchases": f"""select user_id, count(distinct cart_id) as total_carts,
        {_units("cart_quantity")} as total_items_bought,
        {_sum("cart_spend", 2)} as total_spend,
        {_mean("cart_spend", 2)} as avg_cart_value,
        {_round("cast(sum(cart_quantity) as double) / count(cart_quantity)", 1)}
            as avg_basket_size
        from user_carts group by user_id""",
    "category_qty": f"""select user_id, category, {_units("quantity")} as qty_in_category
        from cart_items left join products on product_id = id group by user_id, category""",
    "favourite": """select user_id, category as favourite_category from (
        select *, row_number() over (partition by user_id
            order by qty_in_category desc, category asc nulls last) as place
        from category_qty) where place = 1""",
    "discounts": f"""select user_id,
        {_mean("discount_percentage", 2)} as avg_discount_captured_pct,
        {_round('''cast(cast(sum(cast(line_total as decimal(30, 6))
            - cast(line_discounted_total as decimal(30, 6))) as varchar) as double)''', 2)}
            as total_savings
        from cart_items group by user_id""",
    "customer_360": """select u.id as user_id, first_name, last_name, email, gender,
        age_derived as age, address_city, address_country, company_department, role,
        coalesce(total_carts, 0) as total_carts,
        coalesce(total_items_bought, 0) as total_items_bought,
        coalesce(total_spend, 0) as total_spend, coalesce(avg_cart_value, 0) as avg_cart_value,
        coalesce(avg_basket_size, 0) as avg_basket_size, favourite_category,
        avg_discount_captured_pct, coalesce(total_savings, 0) as total_savings,
        'silver' as source_layer
        from users u left join purchases p on u.id = p.user_id
        left join favourite f on u.id = f.user_id left join discounts d on u.id = d.user_id""",
    "demand": f"""select product_id, {_units("quantity")} as total_units_sold,
        count(distinct cart_id) as times_added_to_cart,
        count(distinct user_id) as unique_buyers,
        {_sum("line_discounted_total", 2)} as total_revenue,
        {_mean("unit_price", 4)} as avg_sold_price,
        {_mean("discount_percentage", 2)} as avg_discount_pct
        from cart_items group by product_id""",
    "performance": f"""select id as product_id, title, category, brand, sku,
        price as catalogue_price, rating, stock, availability_status, weight,
        coalesce(total_units_sold, 0) as total_units_sold,
        coalesce(times_added_to_cart, 0) as times_added_to_cart,
        coalesce(unique_buyers, 0) as unique_buyers,
        coalesce(total_revenue, 0) as total_revenue, avg_sold_price, avg_discount_pct,
        {_round("avg_sold_price - price", 4)} as price_drift,
        total_units_sold as units_or_null, 'silver' as source_layer
        from products left join demand on id = product_id""",
    "product_performance": """select * exclude (units_or_null),
        case when total_units_sold = 0 then 'no_sales' when total_units_sold < 5 then 'low'
            when total_units_sold < 20 then 'medium' else 'high' end as demand_tier
        from performance""",
    "pending": f"""select product_id, {_units("quantity")} as pending_demand
        from cart_items group by product_id""",
    "net": """select id as product_id, title, category, brand, sku, availability_status,
        stock as current_stock, coalesce(p.pending_demand, 0) as pending_demand,
        stock - coalesce(p.pending_demand, 0) as net_stock,
        case when coalesce(p.pending_demand, 0) > 0
            then cast(stock as double) / p.pending_demand end as stock_coverage_ratio,
        'silver' as source_layer from products left join pending p on id = p.product_id""",
    "stock_risk": """select *, case when net_stock <= 0 then 'critical'
        when net_stock <= 5 then 'high' when net_stock <= 20 then 'medium'
        else 'healthy' end as risk_level from net""",
}


def _with(body: str) -> str:
    """Put the needed definitions in front of a query."""
    needed, pending = set(), [body]
    while pending:
        words = set(re.findall(r"\w+", re.sub(r"'[^']*'", "", pending.pop())))
        for name in words & (_CTES.keys() - needed):
            needed.add(name)
            pending.append(_CTES[name])
    definitions = ", ".join(f"{name} as ({sql})" for name, sql in _CTES.items() if name in needed)
    return f"with {definitions} {body}" if definitions else body


def _union(parts: list[str]) -> str:
    return " union all ".join(parts)


def _stage_counts(table: str) -> list[tuple[str, str, str]]:
    read, distinct = f"select count(*) from {_CLEAN[table]}", f"select count(*) from {_DISTINCT[table]}"
    kept = f"select count(*) from {table}"
    rows = [
        ("steps", "01_after_bronze_read", f"({read})"),
        ("steps", "02_after_cleaning", f"({read})"),
        ("steps", "03_after_dedup", f"({distinct})"),
        ("steps", "04_after_quality_filters", f"({kept})"),
        ("dropped", "duplicates", f"({read}) - ({distinct})"),
        ("dropped", "failed_quality_filters", f"({distinct}) - ({kept})"),
        ("dropped", "total", f"({read}) - ({kept})"),
    ]
    rows += [
        (
            "rejected",
            rule,
            f"(select count(*) from {_DISTINCT[table]} where {_failed(table)} = '{rule}')",
        )
        for rule in _RULES[table]
    ]
    rows += [
        ("nulls", column, f"(select count(*) from {_CLEAN[table]} where {column} is null)")
        for column in _WATCHED[table]
    ]
    return rows


def _row(**values: str) -> str:
    return "select " + ", ".join(f'{sql} as "{name}"' for name, sql in values.items())


def _no_zero_nulls(sql: str) -> str:
    return f"select * from ({sql}) where section <> 'nulls' or value > 0"


_SHARES = (
    ("customer_360", "", ()),
    ("product_performance", "demand_tier", ("no_sales", "low", "medium", "high")),
    ("stock_risk", "risk_level", ("critical", "high", "medium", "healthy")),
)
_BOUNDS = (("critical", "0"), ("high", "5"), ("medium", "20"))


def _pipeline_reports() -> list[str]:
    rows = []
    for table in ("products", "users"):
        for section, name, value in _stage_counts(table):
            rows.append((f"{table}_silver", section, name, value))
        rows.append((f"{table}_silver", "steps", "05_written", f"(select count(*) from {table})"))
    rows += [("users_silver", "removed_fields", name, "null") for name in SECRETS]
    summary, items = (
        {f"{s}/{n}": v for s, n, v in _stage_counts(t)} for t in ("cart_summary", "cart_items")
    )
    kept = "steps/04_after_quality_filters"
    carts = {
        "steps/01_after_bronze_read": summary["steps/01_after_bronze_read"],
        "steps/02_cart_summary_ready": summary[kept],
        "steps/03_cart_items_ready": items[kept],
        "steps/05_written": f"{summary[kept]} + {items[kept]}",
    }
    for name in ("duplicates", "failed_quality_filters", "total"):
        carts[f"dropped/{name}"] = f"{summary[f'dropped/{name}']} + {items[f'dropped/{name}']}"
    for table, counts in (("cart_summary", summary), ("cart_items", items)):
        for key, value in counts.items():
            if key.startswith("rejected/"):
                carts[f"rejected/{table}.{key.removeprefix('rejected/')}"] = value
    rows += [("carts_silver", *key.split("/", 1), value) for key, value in carts.items()]
    for name, column, values in _SHARES:
        count = f"(select count(*) from {name}"
        rows.append((f"gold_{name}", "steps", "row_count", f"{count})"))
        rows += [(f"gold_{name}", column, v, f"{count} where {column} = '{v}')") for v in values]
    rows += [("gold_stock_risk", "thresholds", *bound) for bound in _BOUNDS]
    return [
        _row(pipeline=f"'{p}'", section=f"'{s}'", name=f"'{n}'", value=f"cast({v} as bigint)")
        for p, s, n, v in rows
    ]


_LEAVES = {
    "products": _PRODUCT_COLUMNS,
    "users": ["id", *_USER_COLUMNS, "age_derived"],
    "cart_summary": _SUMMARY_COLUMNS,
    "cart_items": _ITEM_COLUMNS,
}

_PURCHASE_COLUMNS = "user_id, total_carts, total_items_bought, total_spend"
_FLAT = ", ".join(f'"{source}" as {name}' for name, source in _USER_COLUMNS.items())
_NATURAL = "\"{0}\" as {0}"

_QUERIES = {
    "bronze_counts": """select 'products' as entity, count(*) as records from raw_products
        union all select 'users', count(*) from raw_users
        union all select 'carts', count(*) from raw_carts
        union all select 'cart_lines', count(*) from raw_lines""",
    "malformed_counts": _union(
        f"""select '{entity}' as entity,
        case when n > 0 then 'malformed' else 'ok' end as status, m - n as record_count,
        n as malformed_count, m - n as records_read, n as set_aside
        from (select count(*) filter (where id % {by} = 0) as n, count(*) as m
            from raw_{entity})"""
        for entity, by in BROKEN.items()
    ),
    "landing_manifest": """select 'products' as entity, 'ok' as status,
        count(*) as record_count, cast(0 as bigint) as malformed_count
        from raw_products union all select 'users', 'ok', count(*), 0 from raw_users
        union all select 'carts', 'ok', count(*), 0 from raw_carts""",
    "file_manifest": _union(
        f"""select '{entity}' as entity, {i} as half,
        count(*) filter (where coalesce(id % 2, 0) = {i}) as record_count, true as has_files
        from raw_{entity}"""
        for entity in BROKEN
        for i in range(2)
    ),
    "incremental_landing": _union(
        f"""select '{entity}' as entity, {run} as run,
        count(*) filter (where {run} < 0 or coalesce(id % 2, 0) = {run}) as record_count
        from raw_{entity}"""
        for entity in BROKEN
        for run in (-1, 0, 1, 2)
    ),
    "products_selected": f"""select id, title, description, category, {_finite("price")} as price,
        "discountPercentage" as discount_percentage, rating, stock, brand,
        "availabilityStatus" as availability_status, sku, weight from raw_products""",
    "products_typed": "select * from typed_products",
    "products_filled": "select * from clean_products",
    "products_dedup": "select * from one_product",
    "silver_products": "select * from products",
    "silver_products_from_json": "select * from products",
    "silver_products_from_ranges": "select * from products",
    "silver_products_from_documents": "select * from products",
    "users_flat": f"select id, {_FLAT} from raw_users",
    "users_age": "select id, email, birth_date, age_derived from clean_users",
    "silver_users": "select * from users",
    "silver_users_from_json": "select * from users",
    "silver_users_from_ranges": "select * from users",
    "silver_users_from_documents": "select * from users",
    "carts_exploded": f"""select cart_id, user_id, id, title, {_finite("price")} as price, quantity,
        {_finite("total")} as total, "discountPercentage",
        {_finite("discountedTotal")} as "discountedTotal" from raw_lines""",
    "silver_cart_summary": "select * from cart_summary",
    "silver_cart_items": "select * from cart_items",
    "silver_cart_items_late": "select * from cart_items",
    "silver_cart_items_from_json": "select * from cart_items",
    "silver_cart_items_from_ranges": "select * from cart_items",
    "silver_cart_items_from_documents": "select * from cart_items",
    "rejects_by_rule": _union(
        f"""select '{table}' as "table", failed_rule, count(*) as rejected
        from (select {_failed(table)} as failed_rule from {_DISTINCT[table]})
        where failed_rule is not null group by failed_rule"""
        for table in _RULES
    ),
    "stage_counts": _no_zero_nulls(
        _union(
            _row(table=f"'{table}'", section=f"'{s}'", name=f"'{n}'", value=f"cast({v} as bigint)")
            for table in _RULES
            for s, n, v in _stage_counts(table)
        )
    ),
    "null_summary": "select * from ("
    + _union(
        f"""select '{table}' as "table", '{column}' as "column", count(*) as nulls
        from {_CLEAN[table]} where {column} is null"""
        for table in _RULES
        for column in _LEAVES[table]
    )
    + ") where nulls > 0",
    "removed_fields": _union(
        f"""select '{field}' as field, count("{field}") as records from raw_users"""
        for field in SECRETS
    ),
    "quality_report_round_trip": _no_zero_nulls(_union(_pipeline_reports())),
    "health_check": """select 'products' as "table", count(*) as row_count, 14 as column_count
        from products union all select 'users', count(*), 34 from users
        union all select 'cart_items', count(*), 13 from cart_items""",
    "user_cart_agg": "select * from purchases",
    "category_quantities": "select * from category_qty",
    "favourite_category": "select * from favourite",
    "discount_agg": "select * from discounts",
    "customer_360": "select * from customer_360",
    "product_demand": "select * from demand",
    "product_demand_unique_lines": "select * from demand",
    "product_demand_sketched": "select * from demand",
    "product_performance": "select * from product_performance",
    "product_performance_literal": """select * exclude (units_or_null),
        case when units_or_null = 0 then 'no_sales' when units_or_null < 5 then 'low'
            when units_or_null < 20 then 'medium' else 'high' end as demand_tier
        from performance""",
    "pending_demand": "select * from pending",
    "stock_risk": "select * from stock_risk",
    "stock_risk_thresholds": """select *, case when net_stock <= -100 then 'critical'
        when net_stock <= 0 then 'high' when net_stock <= 100 then 'medium'
        else 'healthy' end as risk_level from net""",
    "tier_counts": """select demand_tier, count(*) as "count" from product_performance
        group by demand_tier""",
    "risk_counts": """select risk_level, count(*) as "count" from stock_risk
        group by risk_level""",
    "products_audit": """select count(*) as total,
        count(*) filter (where brand = 'unknown') as unknown_brand,
        count(*) filter (where stock = 0) as out_of_stock,
        count(*) filter (where rating = 0) as unrated,
        count(*) filter (where weight = 0) as no_weight from products""",
    "category_distribution": f"""select category, count(*) as product_count,
        {_mean("price", 2)} as avg_price, {_mean("rating", 2)} as avg_rating,
        {_units("stock")} as total_stock from products group by category
        order by count(*) desc, category""",
    "top5_price": """select id, title, category, price, stock, rating from products
        order by price desc, id limit 5""",
    "age_discrepancy": """select id, first_name, age as age_raw, age_derived,
        age - age_derived as discrepancy from users where abs(age - age_derived) > 1
        order by abs(age - age_derived) desc, id limit 10""",
    "gender_distribution": """select gender, count(*) as "count" from users group by gender
        order by count(*) desc, gender""",
    "country_top10": """select address_country, count(*) as users from users
        group by address_country order by count(*) desc, address_country limit 10""",
    "role_distribution": """select role, count(*) as "count" from users group by role
        order by count(*) desc, role""",
    "float_audit": """select cart_id, product_id, product_title, line_total,
        line_total_recomputed, line_total_discrepancy from cart_items
        where abs(line_total_discrepancy) > 0.001
        order by abs(line_total_discrepancy) desc, cart_id, product_id limit 10""",
    "top10_products_sold": f"""select product_id, product_title,
        {_units("quantity")} as total_qty_sold,
        count(distinct cart_id) as carts_appeared_in,
        {_mean("unit_price", 2)} as avg_unit_price
        from cart_items group by product_id, product_title
        order by sum(quantity) desc, product_id, product_title limit 10""",
    "cart_summary_report": f"""select count(distinct cart_id) as total_carts,
        {_round("cast(sum(lines) as double) / count(lines)", 1)} as avg_products_per_cart,
        {_round("cast(sum(units) as double) / count(units)", 1)} as avg_quantity_per_cart,
        {_mean("total", 2)} as avg_cart_total, {_mean("paid", 2)} as avg_after_discount
        from (select cart_id, count(distinct product_id) as lines, sum(quantity) as units,
            sum(cast(line_total as decimal(30, 6))) as total,
            sum(cast(line_discounted_total as decimal(30, 6))) as paid
            from cart_items group by cart_id)""",
    "revenue_by_category": f"""select category, count(distinct cart_id) as carts,
        {_units("quantity")} as units_sold, {_sum("line_discounted_total", 2)} as revenue,
        {_mean("rating", 2)} as avg_product_rating
        from cart_items join products on product_id = id group by category
        order by revenue desc, category""",
    "top10_spenders": """select id as user_id, first_name || ' ' || last_name as full_name,
        address_country, total_carts, total_items_bought, total_spend
        from users join purchases on id = purchases.user_id
        order by total_spend desc, id limit 10""",
    "basket_by_age_band": f"""select case when age_derived between 16 and 25 then '16-25'
        when age_derived between 26 and 35 then '26-35'
        when age_derived between 36 and 50 then '36-50' else '51+' end as age_group,
        count(distinct cart_id) as carts,
        {_round("cast(sum(cart_quantity) as double) / count(cart_quantity)", 1)}
            as avg_basket_size,
        {_mean("cart_spend", 2)} as avg_cart_value
        from users join user_carts on id = user_id group by 1 order by age_group""",
    "stock_risk_report": """select id, title, category, stock, pending.pending_demand,
        stock - pending.pending_demand as net_stock
        from products join pending on id = product_id
        where stock - pending.pending_demand < 5 order by net_stock, id""",
    "panel_revenue": f"""select category, {_sum("total_revenue", 2)} as revenue
        from product_performance group by category order by revenue desc, category""",
    "panel_spend_tiers": """select case when total_spend < 1 then '<1'
        when total_spend < 500000 then '1-500000'
        when total_spend < 1000000.1 then '500000-1000000.1'
        when total_spend < 1000000.2 then '1000000.1-1000000.2'
        when total_spend < 2000000 then '1000000.2-2000000' else '2000000+' end as spend_tier,
        count(*) as users from customer_360 group by 1""",
    "panel_stock_alert": "select * from stock_risk where risk_level in ('critical', 'high')",
    "panel_top10": """select user_id, first_name, last_name, email, total_spend
        from customer_360 order by total_spend desc, user_id limit 10""",
    "stored_users": "select * from users",
    "stored_customer_360": "select * from customer_360",
    "stored_product_performance": "select * from product_performance",
    "stored_stock_alert": "select * from stock_risk where risk_level in ('critical', 'high')",
    "stored_user_lines": "select * from cart_items where user_id = 4",
    "bucketed_user_cart_agg": "select * from purchases",
    "bucketed_customer_360": "select * from customer_360",
    "stored_views_sql": """select address_country as country, role, count(*) as lines,
        count(distinct brand) as brands from cart_items join users on user_id = users.id
        left join products on product_id = products.id group by address_country, role""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in _QUERIES.items()}
