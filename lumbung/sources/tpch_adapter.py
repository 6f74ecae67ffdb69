"""Raw retail tables derived from TPC-H-like Parquet files.

Everything is a projection of one file, except class tables (a distinct over a small domain),
``cities`` (two tiny tables) and the item numbers of ``order_items`` (one ordered pass per
order). ``faulty=True`` plants violations for the data-quality checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.operators.ordered import OrderedSpec, ordered
from lumbung.operators.rules import order_number, sku
from lumbung.operators.skew import DEFAULT, SkewSettings
from lumbung.schemas import RAW_SCHEMAS

# Columns of the files.
FILE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
}

# Rows of the reference dimensions.
PAYMENT_METHODS = [
    (1, "E-wallet", "Digital wallet"),
    (2, "QRIS", "QR payment"),
    (3, "COD", "Cash on delivery"),
    (4, "Paylater", "Consumer credit"),
]
SHIPPING_SERVICES = [
    (1, "JNE", "REG", "Regular", 2, 5),
    (2, "JNE", "YES", "Express", 1, 2),
    (3, "SiCepat", "REG", "Regular", 2, 4),
    (4, "J&T", "EZ", "Regular", 2, 5),
    (5, "AnterAja", "Regular", "Regular", 2, 5),
    (6, "Ninja Xpress", "Standard", "Regular", 3, 6),
    (7, "GrabExpress", "Instant", "Same Day", 0, 1),
    (8, "GoSend", "Instant", "Same Day", 0, 1),
]
VOUCHERS = [
    (1, "NO_DISCOUNT", "No discount", "none", "Tidak menggunakan voucher.", 0, 0, "0.00"),
    (2, "CASHBACK_10_MIN_200K", "Cashback 10% minimal belanja 200k", "cashback",
     "Minimal belanja Rp200.000 mendapat cashback 10% dari total belanja.", 200000, 0, "0.10"),
    (3, "FREE_SHIPPING_MIN_50K", "Free ongkir minimal belanja 50k", "shipping_discount",
     "Minimal belanja Rp50.000 mendapat subsidi ongkir.", 50000, 0, "0.00"),
    (4, "ELECTRONICS_100K", "Potongan langsung elektronik 100k", "direct_discount",
     "Potongan langsung Rp100.000 hanya untuk barang kategori Electronics.", 0, 100000, "0.00"),
]
LOYALTY_TIERS = ["New", "Regular", "Silver", "Gold", "Platinum"]
SHIPPING_FEES = [8500, 11500, 14000, 17500, 24500, 33000, 47500]

#: Part type -> category name.
PART_CATEGORIES = {
    "ECONOMY": "Electronics",
    "LARGE": "Fashion",
    "MEDIUM": "Beauty",
    "PROMO": "Home & Living",
    "SMALL": "Sports",
    "STANDARD": "Books",
}


def _sql_array(values: list) -> str:
    return "array(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def _sql_case(column: str, mapping: dict, default: str) -> str:
    arms = " ".join(f"when '{k}' then {v}" for k, v in mapping.items())
    return f"case {column} {arms} else {default} end"


DIMENSION_STAMP = "timestamp_ntz'1995-01-01 00:00:00' as loaded_at"
YEAR_END = "make_timestamp_ntz(year({d}) + 1, 1, 1, 0, 0, 0)"

CATEGORY_NAME = _sql_case("p_type", {k: f"'{v}'" for k, v in PART_CATEGORIES.items()}, "'Automotive'")
CATEGORY_NUMBER = _sql_case("p_type", {k: i + 1 for i, k in enumerate(PART_CATEGORIES)}, "0")
CATEGORY_ID = f"cast({CATEGORY_NUMBER} * 1000 + cast(substring(p_brand, 7) as int) % 1000 as bigint)"

ORDER_STATUS = """case o_orderstatus
    when 'O' then case when o_orderkey % 10 < 3 then 'placed' when o_orderkey % 10 < 5 then 'paid'
                       when o_orderkey % 10 < 7 then 'packed' else 'shipped' end
    when 'F' then case when o_orderkey % 10 < 8 then 'delivered' else 'returned' end
    else case when o_orderkey % 10 < 2 then 'cancelled' when o_orderkey % 10 < 3 then 'returned'
              else 'delivered' end end"""
CANCELLATION_STAGE = f"""case when {ORDER_STATUS} = 'cancelled'
    then element_at({_sql_array(["placed", "paid", "packed", "shipped"])}, cast(o_orderkey div 10 % 4 + 1 as int)) end"""


class RetailTables:
    """Lazy raw tables over one folder of TPC-H-like Parquet files."""

    def __init__(
        self, spark: SparkSession, sf_dir: str, faulty: bool = False, settings: SkewSettings = DEFAULT
    ) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.faulty = faulty
        self.settings = settings
        self._made: dict[str, DataFrame] = {}
        self._files: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._made:
            typed = [f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in RAW_SCHEMAS[table].fields]
            self._made[table] = getattr(self, f"_{table}")().selectExpr(*typed)
        return self._made[table]

    def all(self) -> dict[str, DataFrame]:
        return {t: self[t] for t in RAW_SCHEMAS}

    def _read(self, name: str) -> DataFrame:
        if name not in self._files:
            reader = self.spark.read.schema(FILE_SCHEMAS[name])
            self._files[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._files[name]

    def _classes(self, name: str, class_id: str, rows: list[tuple], columns: list[str]) -> DataFrame:
        """Fixed rows whose class number occurs in a file; at most ``len(rows)`` rows."""
        values = ", ".join(str(tuple(r)) for r in rows)
        fixed = self.spark.sql(f"select * from values {values} as t({', '.join(columns)})")
        seen = self._read(name).selectExpr(f"cast({class_id} as int) as class_id").distinct()
        return seen.join(F.broadcast(fixed), seen["class_id"] == fixed[columns[0]], "inner").selectExpr(
            "*", DIMENSION_STAMP
        )

    def _cities(self) -> DataFrame:
        # Fixed-size tables: 25 nations, 5 regions.
        region = self._read("region")
        nation = self._read("nation")
        return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).selectExpr(
            "n_nationkey as city_id", "n_name as city_name", "r_name as province", "r_name as region",
            "'-' as country", DIMENSION_STAMP,
        )

    def _categories(self) -> DataFrame:
        seen = self._read("part").select("p_type", "p_brand").distinct()
        return seen.selectExpr(
            f"{CATEGORY_ID} as category_id", f"{CATEGORY_NAME} as category_name", "p_brand as subcategory_name",
            f"{CATEGORY_NAME} as department", DIMENSION_STAMP,
        )

    def _products(self) -> DataFrame:
        price = "cast(floor(p_retailprice) as bigint)"
        return self._read("part").selectExpr(
            "p_partkey as product_id",
            f"{sku(CATEGORY_NAME, 'p_partkey')} as sku",
            "p_name as product_name", f"{CATEGORY_ID} as category_id",
            f"{price} as standard_price", f"{price} * 7 div 10 as estimated_unit_cost",
            "p_size % 10 <> 0 as is_active",
            "timestamp_ntz'1994-01-01 00:00:00' + make_dt_interval(cast(p_partkey % 365 as int)) as created_at",
            DIMENSION_STAMP,
        )

    def _payment_methods(self) -> DataFrame:
        return self._classes(
            "orders", "(cast(substring(o_orderpriority, 1, 1) as int) - 1) % 4 + 1", PAYMENT_METHODS,
            ["payment_method_id", "payment_method_name", "payment_group"],
        )

    def _shipping_services(self) -> DataFrame:
        return self._classes(
            "supplier", "s_suppkey % 8 + 1", SHIPPING_SERVICES,
            ["shipping_service_id", "shipping_provider", "shipping_service", "service_level",
             "min_delivery_days", "max_delivery_days"],
        )

    def _vouchers(self) -> DataFrame:
        return self._classes(
            "part", "p_size % 4 + 1", VOUCHERS,
            ["voucher_id", "voucher_code", "voucher_name", "voucher_type", "rule_description",
             "min_order_amount", "discount_amount", "cashback_rate"],
        )

    def _customer_profile_events(self) -> DataFrame:
        first = """case when c_custkey % 10 = 3 then timestamp_ntz'1996-06-01 08:00:00'
            else timestamp_ntz'1994-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 200 as int)) end"""
        second = """timestamp_ntz'1997-01-01 00:00:00'
            + make_dt_interval(cast(c_custkey % 400 as int), cast(c_custkey % 24 as int))"""
        third = """timestamp_ntz'1999-03-01 00:00:00'
            + make_dt_interval(cast(c_custkey % 300 as int), 0, cast(c_custkey % 60 as int))"""
        # Ties are planted in the faulty variant: the second event repeats the first one's time.
        if self.faulty:
            second = f"case when c_custkey % 90 = 0 then {first} else {second} end"
        steps = f"""explode(filter(array(
            named_struct('seq', 1, 'at', {first}, 'keep', true),
            named_struct('seq', 2, 'at', {second}, 'keep', c_custkey % 3 = 0),
            named_struct('seq', 3, 'at', {third}, 'keep', c_custkey % 6 = 0)), s -> s.keep)) as s"""
        operation = "case when s.seq = 1 then 'insert' else 'update' end"
        if self.faulty:
            operation = f"case when c_custkey % 211 = 0 then 'delete' else {operation} end"
        return self._read("customer").selectExpr("*", steps).selectExpr(
            "c_custkey * 3 + s.seq as customer_profile_event_id", "c_custkey as customer_id",
            "c_name as full_name", "concat(c_name, '.', s.seq, '@Mail.Example') as email",
            "case when c_custkey % 2 = 0 then 'Female' else 'Male' end as gender",
            "date_add(date'1950-01-01', cast(c_custkey * 37 % 15000 as int)) as birth_date",
            "(c_nationkey + (s.seq - 1) * 7) % 25 as city_id",
            f"element_at({_sql_array(LOYALTY_TIERS)}, cast((c_custkey + s.seq) % 5 + 1 as int)) as loyalty_tier",
            "(c_custkey + s.seq) % 2 = 0 as marketing_opt_in", "s.at as effective_at",
            f"{operation} as operation", YEAR_END.format(d="s.at") + " as loaded_at",
        )

    def _order_base(self) -> DataFrame:
        """Order header columns shared by orders, payments, shipments and status events."""
        return self._read("orders").selectExpr(
            "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice",
            "o_orderdate + make_dt_interval(0, 0, cast(o_orderkey * 37 % 1440 as int)) as order_ts",
            f"{ORDER_STATUS} as order_status", f"{CANCELLATION_STAGE} as cancellation_stage",
            "o_orderkey % 8 + 1 as shipping_service_id", "o_orderkey div 8 % 4 + 1 as voucher_id",
            YEAR_END.format(d="o_orderdate") + " as loaded_at",
        )

    def _orders(self) -> DataFrame:
        status = "case when o_orderkey % 503 = 0 then 'lost' else order_status end" if self.faulty else "order_status"
        return self._order_base().selectExpr(
            "o_orderkey as order_id",
            f"{order_number('order_ts', 'o_orderkey')} as order_number",
            "o_custkey as customer_id", "order_ts", f"{status} as order_status", "cancellation_stage",
            "(cast(substring(o_orderpriority, 1, 1) as int) - 1) % 4 + 1 as payment_method_id",
            "shipping_service_id", "voucher_id", "'web' as sales_channel", "'IDR' as currency", "loaded_at",
        )

    def _order_items(self) -> DataFrame:
        # Whole-row order: lines agreeing in every column are interchangeable.
        order = [
            "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "quantity", "subtotal", "percent",
            "tax", "l_returnflag", "l_linestatus",
        ]
        lines = self._read("lineitem").selectExpr(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cast(l_quantity as int) as quantity",
            "cast(floor(l_extendedprice) as bigint) as subtotal",
            "cast(round(l_discount * 100) as int) as percent", "cast(round(l_tax * 100) as int) as tax",
            "l_returnflag", "l_linestatus", "l_shipdate",
        )
        numbered = ordered(lines, ["l_orderkey"], order, OrderedSpec(sequence="item_number"), self.settings)
        voucher = "l_orderkey div 8 % 4 + 1"
        amounts = numbered.selectExpr(
            "*", "subtotal * percent div 100 as discount_amount",
            f"case {voucher} when 2 then subtotal div 10 when 4 then least(100000, subtotal div 4) else 0 end"
            " as voucher_amount",
            f"case {voucher} when 3 then 100 + l_suppkey % 50 else 0 end as shipping_subsidy",
            "subtotal * (45 + l_suppkey % 30) div 100 as estimated_cost",
        )
        total, profit = "subtotal - discount_amount - voucher_amount", "total_payment - estimated_cost - shipping_subsidy"
        item_quantity, number = "quantity", "item_number"
        if self.faulty:
            number = "case when l_orderkey % 1019 < 2 then 1 else item_number end"
            total = f"{total} + case when l_orderkey % 997 = 0 then 1 when l_orderkey % 1009 = 0 then -200000 else 0 end"
            profit = f"{profit} - case when l_orderkey % 991 = 0 then 5 else 0 end"
            item_quantity = "case when l_orderkey % 1013 = 0 then 0 else quantity end"
        return amounts.selectExpr("*", f"{total} as total_payment").selectExpr(
            # Room for ten million items in one order.
            "l_orderkey * 10000000 + item_number as order_item_id", "l_orderkey as order_id",
            "l_partkey as product_id", f"{number} as item_number", f"{item_quantity} as quantity",
            "subtotal div quantity as unit_price", "subtotal", "discount_amount", "shipping_subsidy",
            "voucher_amount", "total_payment", "estimated_cost", f"{profit} as profit",
            "l_returnflag = 'R' and l_linenumber % 3 = 0 as is_returned",
            "l_returnflag = 'A' and l_linenumber % 4 = 1 as is_cancelled",
            YEAR_END.format(d="l_shipdate") + " as loaded_at",
        )

    def _payments(self) -> DataFrame:
        return self._order_base().filter("order_status <> 'placed'").selectExpr(
            "o_orderkey as payment_id", "o_orderkey as order_id",
            "order_ts + make_dt_interval(0, 0, cast(o_orderkey % 120 + 1 as int)) as payment_ts",
            "(cast(substring(o_orderpriority, 1, 1) as int) - 1) % 4 + 1 as payment_method_id",
            "case when order_status = 'cancelled' and cancellation_stage = 'placed' then 'cancelled'"
            " when order_status = 'returned' then 'refunded' else 'paid' end as payment_status",
            "cast(floor(o_totalprice) as bigint) as payment_amount",
            "concat('PAY-', upper(substring(md5(cast(o_orderkey as string)), 1, 16))) as transaction_reference",
            "loaded_at",
        )

    def _shipments(self) -> DataFrame:
        max_days = _sql_array([row[5] for row in SHIPPING_SERVICES])
        dispatched = """order_status in ('shipped', 'delivered', 'returned')
            or (order_status = 'cancelled' and cancellation_stage = 'shipped')"""
        arrived = "order_status in ('delivered', 'returned')"
        # Steps of 30 seconds keep sums of minutes exact in binary floating point.
        return self._order_base().filter("order_status not in ('placed', 'paid')").selectExpr(
            "*",
            f"""case when {dispatched} then order_ts + make_dt_interval(
                0, cast(o_orderkey % 48 + 2 as int), 0, cast(o_orderkey % 3 * 30 as int)) end as shipped_ts""",
        ).selectExpr(
            "*",
            f"""case when {arrived} then shipped_ts + make_dt_interval(
                cast(o_orderkey % 9 as int), 0, cast(o_orderkey % 7 * 30 as int), cast(o_orderkey % 2 * 30 as int))
                end as delivered_ts""",
        ).selectExpr(
            "o_orderkey as shipment_id", "o_orderkey as order_id", "shipping_service_id",
            "order_ts as checkout_ts", "shipped_ts", "delivered_ts",
            f"element_at({_sql_array(SHIPPING_FEES)}, cast(o_orderkey % 7 + 1 as int)) as shipping_fee",
            f"case when voucher_id = 3 then element_at({_sql_array(SHIPPING_FEES)}, cast(o_orderkey % 7 + 1 as int))"
            " else 0 end as shipping_subsidy",
            f"delivered_ts is not null and o_orderkey % 9 > element_at({max_days}, cast(shipping_service_id as int))"
            " as is_delayed",
            "case when order_status = 'cancelled' then 'cancelled' when delivered_ts is not null then 'delivered'"
            " else 'in_progress' end as shipping_status",
            "case when shipped_ts is not null then concat('TRK', 10000000 + o_orderkey % 90000000) end"
            " as tracking_number",
            "loaded_at",
        )

    def _order_status_events(self) -> DataFrame:
        # reached: last stage passed, 1 = placed .. 5 = delivered.
        stages = _sql_array(["placed", "paid", "packed", "shipped", "delivered"])
        broken = "and not (o_orderkey % 101 = 0 and s = 3)" if self.faulty else ""
        path = f"""explode(flatten(array(
            transform(filter(sequence(1, reached), s -> true {broken}),
                s -> named_struct('seq', s, 'status', element_at({stages}, s), 'hours', (s - 1) * 7 + (s - 1) * (s - 1))),
            if(order_status = 'cancelled',
                array(named_struct('seq', 6, 'status', 'cancelled',
                    'hours', (reached - 1) * 7 + (reached - 1) * (reached - 1) + 2)),
                array()),
            if(order_status = 'returned',
                array(named_struct('seq', 7, 'status', 'returned', 'hours', 24 * 10)),
                array())))) as e"""
        return self._order_base().selectExpr(
            "o_orderkey", "order_ts", "order_status", "loaded_at",
            f"""cast(case when order_status = 'cancelled' then array_position({stages}, cancellation_stage)
                when order_status = 'returned' then 5
                else array_position({stages}, order_status) end as int) as reached""",
        ).selectExpr("*", path).selectExpr(
            "o_orderkey * 10 + e.seq as status_event_id", "o_orderkey as order_id", "e.status as status",
            "order_ts + make_dt_interval(0, cast(e.hours as int), cast(o_orderkey % 60 * (e.seq - 1) as int)) as status_ts",
            "loaded_at",
        )
