"""Raw shop records made from the test tables: parts as products, customers as users, orders
with their lines as carts.

Every row of the tables takes part. Dirty values are put in by key, so that each cleaning
rule has something to do. The flat expressions run unchanged on Spark and on DuckDB, which
uses them for the reference results.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Copies of a record: a second, different one for some keys.
PRODUCT_COPIES = "case when p_partkey % 50 = 0 then 2 else 1 end"
USER_COPIES = "case when c_custkey % 67 = 0 then 2 else 1 end"

PRODUCT = {
    "id": "case when p_partkey % 211 = 5 then null else p_partkey end",
    "title": "concat(' ', p_name, ' ')",
    "description": "p_name",
    "category": "concat(' ', p_type, ' ')",
    "price": """case when p_partkey % 101 = 0 then cast(-1 as double)
        when p_partkey % 103 = 1 then cast('NaN' as double)
        when p_partkey % 107 = 1 then cast('Infinity' as double)
        when p_partkey % 109 = 1 then cast(1e30 as double)
        else p_retailprice + cast(copy - 1 as double) * (p_partkey % 100) end""",
    "discountPercentage": """case when p_partkey % 31 = 0 then null
        else cast(p_partkey % 110 as double) end""",
    "rating": """case when p_partkey % 29 = 0 then null
        else cast(p_partkey % 52 as double) / 10 end""",
    "stock": """case when p_partkey % 23 = 0 then null when p_partkey % 97 = 0 then -5
        when p_partkey % 7 in (1, 2) then p_size else p_size * 25 end""",
    "brand": """case when p_partkey % 17 = 0 then null when p_partkey % 19 = 0 then '   '
        else concat(' ', p_brand) end""",
    "availabilityStatus": "case when p_size < 10 then ' Low Stock' else 'In Stock ' end",
    "sku": "concat('SKU-', cast(p_partkey as varchar(20)))",
    "weight": "case when p_partkey % 37 = 0 then null else cast(p_size as double) end",
}

USER = {
    "id": "c_custkey",
    "firstName": "concat(' ', c_mktsegment)",
    "lastName": "c_name",
    "age": "cast(c_custkey % 80 + 10 as int)",
    "gender": """case when c_custkey % 4 = 0 then 'Male ' when c_custkey % 4 = 1 then 'female'
        when c_custkey % 4 = 2 then 'other' when c_custkey % 12 = 3 then 'unknown'
        else 'FEMALE' end""",
    "email": """case when c_custkey % 13 = 0 then concat('nomail', cast(c_custkey as varchar(20)))
        when c_custkey % 59 = 0 then null
        else concat(' U', cast(c_custkey as varchar(20)), '@Example', cast(copy as varchar(1)),
            '.com ') end""",
    "phone": "concat('+1 ', cast(c_custkey as varchar(20)))",
    "username": "concat('user', cast(c_custkey as varchar(20)))",
    "birthDate": """case when c_custkey % 71 = 0 then '1999-13-40'
        else concat(cast(1930 + (c_custkey * 37) % 83 as varchar(4)), '-',
            cast(1 + c_custkey % 12 as varchar(2)), '-',
            cast(1 + c_custkey % 28 as varchar(2))) end""",
    "bloodGroup": "case when c_custkey % 2 = 0 then 'A+' else 'O-' end",
    "height": "cast(150 + c_custkey % 50 as double)",
    "weight": "cast(50 + c_custkey % 60 as double)",
    "eyeColor": "case when c_custkey % 3 = 0 then 'Green' else 'Brown' end",
    "hair.color": "case when c_custkey % 5 = 0 then 'Black' else 'Red' end",
    "hair.type": "case when c_custkey % 2 = 0 then 'Curly' else 'Straight' end",
    "address.address": "concat(cast(c_custkey as varchar(20)), ' Main Street')",
    "address.city": "concat(' City ', cast(c_custkey % 300 as varchar(3)), ' ')",
    "address.state": "concat('State ', cast(c_custkey % 50 as varchar(2)))",
    "address.stateCode": "concat('S', cast(c_custkey % 50 as varchar(2)))",
    "address.postalCode": "cast(10000 + c_custkey % 90000 as varchar(5))",
    "address.country": "concat(n_name, ' ')",
    "address.coordinates.lat": "cast(c_custkey % 180 - 90 as double)",
    "address.coordinates.lng": "cast(c_custkey % 360 - 180 as double)",
    "university": "concat('University ', cast(c_custkey % 20 as varchar(2)))",
    "role": """case when c_custkey % 10 = 0 then ' Admin' when c_custkey % 10 < 3 then 'moderator '
        else 'USER' end""",
    "company.name": "concat(' Company ', cast(c_custkey % 90 as varchar(2)))",
    "company.department": """case when c_custkey % 8 = 0 then null
        else concat(' Department ', cast(c_custkey % 12 as varchar(2)), ' ') end""",
    "company.title": "concat('Title ', cast(c_custkey % 15 as varchar(2)))",
    "bank.cardType": "case when c_custkey % 2 = 0 then 'Visa' else 'Maestro' end",
    "bank.currency": "'Euro'",
    "bank.cardExpire": "concat('0', cast(1 + c_custkey % 9 as varchar(1)), '/29')",
}

# Sensitive fields, there to be left out.
SECRETS = {
    "bank.cardNumber": "cast(4000000000000000 + c_custkey as varchar(20))",
    "bank.iban": "concat('XX', cast(c_custkey as varchar(20)))",
    "password": "concat('pass', cast(c_custkey as varchar(20)))",
    "ssn": "cast(c_custkey as varchar(20))",
    "ein": "case when c_custkey % 3 = 0 then null else cast(c_custkey as varchar(20)) end",
    "ip": "'10.0.0.1'",
    "macAddress": "'00:00:00:00:00:00'",
    "userAgent": "'browser'",
    "crypto": "'wallet'",
    "image": "'https://example.com/image.png'",
}

CART = {
    "id": "o_orderkey",
    "userId": "case when o_custkey % 10 = 3 then null else o_custkey end",
    "totalProducts": "case when o_orderkey % 41 = 0 then 0 else cast(1 + o_orderkey % 7 as int) end",
    "totalQuantity": "cast(10 + o_orderkey % 70 as int)",
    "total": """case when o_orderkey % 350 = 0 then cast(0 as double)
        when o_orderkey % 353 = 1 then cast('NaN' as double)
        when o_orderkey % 359 = 1 then cast(1e30 as double)
        when o_orderkey % 211 = 0 then cast(-1 as double) else o_totalprice end""",
    "discountedTotal": "floor(o_totalprice * (100 - o_orderkey % 11) + 0.5) / 100",
}

LINE = {
    "id": "case when l_partkey % 307 = 4 then null else l_partkey end",
    "title": "concat(' Part ', cast(l_partkey as varchar(20)), ' ')",
    "price": """case when l_partkey % 59 = 0 then cast(0 as double)
        when l_partkey % 103 = 2 then cast('NaN' as double)
        when l_partkey % 107 = 2 then cast('Infinity' as double)
        else floor(l_extendedprice * 100 / l_quantity + 0.5) / 100 end""",
    "quantity": """case when l_partkey % 43 = 0 then 0
        when l_partkey % 7 = 1
            then case when l_linenumber = 1 and l_suppkey % 3 = 0 then 1 else 0 end
        when l_partkey % 7 = 2 then case when l_linenumber < 4 then 1 else 0 end
        else cast(l_quantity as int) end""",
    "total": """case when l_partkey % 113 = 3 then cast('Infinity' as double)
        when l_partkey % 109 = 3 then cast(1e30 as double) else l_extendedprice end""",
    "discountPercentage": """case when l_partkey % 61 = 0 then cast(101 as double)
        else cast(floor(l_discount * 100 + 0.5) as double) end""",
    "discountedTotal": """case when l_partkey % 127 = 5 then cast(1e30 as double)
        when l_partkey % 131 = 6 then cast('NaN' as double)
        else floor(l_extendedprice * (100 - floor(l_discount * 100 + 0.5)) + 0.5) / 100 end""",
}

# Some headers differ between the records of an order.
CART_OF_LINE = CART | {
    "totalQuantity": f"""({CART["totalQuantity"]})
        + case when o_orderkey % 29 = 0 then cast(l_linenumber as int) else 0 end"""
}

# Raw records whose id can be divided by this are cut off in their text; ids per document.
BROKEN = {"products": 13, "users": 17, "carts": 19}
PER_DOCUMENT = 5000


def listing(expressions: dict[str, str]) -> str:
    return ", ".join(f'{sql} as "{name}"' for name, sql in expressions.items())


def _struct(expressions: dict[str, str], prefix: str = "") -> str:
    """Spark struct of flat dotted names."""
    fields, seen = [], set()
    for name, sql in expressions.items():
        if not name.startswith(prefix):
            continue
        head, _, tail = name.removeprefix(prefix).partition(".")
        if head in seen:
            continue
        seen.add(head)
        value = _struct(expressions, f"{prefix}{head}.") if tail else f"({sql})"
        fields.append(f"'{head}', {value}")
    return f"named_struct({', '.join(fields)})"


# Schemas of the test tables used, so that reading them takes no job to look them up.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_totalprice double, o_orderdate timestamp, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _copied(df: DataFrame, copies: str) -> DataFrame:
    return df.selectExpr("*", f"explode(sequence(1, {copies})) as copy")


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _copied(table(spark, sf_dir, "part"), PRODUCT_COPIES)
    return parts.selectExpr(*[f"{sql} as {name}" for name, sql in PRODUCT.items()])


def bronze_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey as c_nationkey", "n_name")
    people = table(spark, sf_dir, "customer").join(nations, "c_nationkey")
    return _copied(people, USER_COPIES).selectExpr(f"inline(array({_struct(USER | SECRETS)}))")


def bronze_carts(spark: SparkSession, sf_dir: str, per_part: int | None = None) -> DataFrame:
    """A raw record per order without lines, and one per line with the order's figures.

    Records of the same order are not gathered into one: that would put all lines of an
    order into one row, however many there are. Some lines come twice in their record.

    With ``per_part`` the first column, ``part``, says of which range of so many ids a record is,
    and orders and lines meet by that: in a session that allows it (see ``_building`` in
    ``harness/queries.py``) records are grouped by it without being moved a second time.
    """
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    meet, part = lines.l_orderkey == orders.o_orderkey, []
    if per_part is not None:
        # Records without an id, of which there may be many, are spread over many parts.
        loose = -1 - F.pmod(F.xxhash64("o_custkey", "o_totalprice"), F.lit(64))
        ranged = F.coalesce(F.floor(F.col("o_orderkey") / per_part), loose)
        orders = orders.withColumn("part", ranged).repartition("part")
        ranged = F.floor(F.col("l_orderkey") / per_part)
        lines = lines.withColumn("l_part", ranged).repartition("l_part")
        meet = (lines.l_part == orders.part) & (lines.l_orderkey == orders.o_orderkey)
        part = ["part"]
    header = [*part, *[f"{sql} as {name}" for name, sql in CART.items()]]
    own = [*part, *[f"{sql} as {name}" for name, sql in CART_OF_LINE.items()]]
    bumped = LINE | {"quantity": f"({LINE['quantity']}) + 1"}
    # Both sides are large tables, however few rows a test has: join them by shuffle.
    sold = lines.join(orders.hint("merge"), meet).selectExpr(
        *own,
        f"case when l_linenumber = 7 then array({_struct(LINE)}, {_struct(bumped)}) "
        f"else array({_struct(LINE)}) end as products",
    )
    array_type = sold.schema["products"].dataType.simpleString()
    bare = orders.selectExpr(
        *header, f"case when o_orderkey % 2 = 0 then cast(array() as {array_type}) end as products"
    )
    return bare.unionByName(sold)
