"""Raw tables the given data lacks, derived from the tables it has.

The given tables cover a reduced order-line schema. Shops, inventories and logs are computed
from them, row by row or by grouping, so they grow with the data. ``Given`` holds the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martmill.functions.calendar import spine_over
from martmill.functions.columns import to_date, trunc_month
from martmill.plans import tpch
from martmill.sources.tables import exact, scan_source

# Money columns, by table: binary floats in the files, exact to two places.
_MONEY = {
    "customer": ["c_acctbal"],
    "supplier": ["s_acctbal"],
    "part": ["p_retailprice"],
    "orders": ["o_totalprice"],
    "lineitem": ["l_quantity", "l_extendedprice"],
}
_RATES = {"lineitem": ["l_discount", "l_tax"]}


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


class Given:
    """The tables under one folder, and everything derived from them. All lazy."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def raw(self, name: str) -> DataFrame:
        df = scan_source(self.spark, self.root, name)
        for c in _MONEY.get(name, []):
            df = df.withColumn(c, exact(c))
        for c in _RATES.get(name, []):
            df = df.withColumn(c, exact(c, 4, 2))
        return df

    # ---- order-line warehouse ----

    def stage(self, name: str) -> DataFrame:
        return tpch.stage(self.raw(name), name)

    def partsupp(self) -> DataFrame:
        """Pairs of part and supplier met in the order lines."""
        lines = scan_source(self.spark, self.root, "lineitem")
        return lines.groupBy(F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")).agg(
            F.sum(exact("l_quantity")).cast("bigint").alias("ps_availqty"),
            F.max(exact("l_extendedprice")).alias("ps_supplycost"),
        )

    def customer_geo(self) -> DataFrame:
        return tpch.customer_geo(self.stage("customer"), self.stage("nation"), self.stage("region"))

    def lineitem_enriched(self) -> DataFrame:
        return tpch.lineitem_enriched(self.stage("lineitem"), self.stage("orders"), self.stage("customer"))

    def order_days(self) -> DataFrame:
        """Every calendar day between the first and the last order."""
        return spine_over(scan_source(self.spark, self.root, "orders"), "o_orderdate")

    # ---- bike shop ----

    def bike_customers(self) -> DataFrame:
        nation = self.raw("nation").select("n_nationkey", F.col("n_name").alias("city"))
        gender = F.when(F.col("c_custkey") % 4 == 0, "F").when(F.col("c_custkey") % 4 == 1, "M").when(
            F.col("c_custkey") % 4 == 2, "X"
        )
        return self.raw("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
            F.col("c_custkey").alias("id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            gender.alias("gender"),
            "city",
            F.lit("2001-09-01").cast("timestamp_ntz").alias("loaded_at"),
        )

    def bike_products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("model"),
            F.col("p_brand").alias("category"),
            F.concat(F.lit("Size "), _text("p_size")).alias("subcategory"),
            F.col("p_type").alias("frame"),
            F.col("p_retailprice").alias("price"),
            (F.col("p_retailprice") * F.lit("0.4688").cast("decimal(4,4)")).alias("product_cost"),
            F.lit("2001-09-01").cast("timestamp_ntz").alias("loaded_at"),
        )

    def bike_orders(self) -> DataFrame:
        status = F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "PENDING")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("customer_id"),
            status.otherwise(F.lit("SHIPPED")).alias("order_status"),
            to_date("o_orderdate").alias("order_date"),
            F.col("o_orderdate").alias("loaded_at"),
        )

    def bike_order_products(self) -> DataFrame:
        """One row per order and line number; products divisible by 97 point nowhere."""
        product = F.min("l_partkey")
        lines = self.raw("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
            F.when(product % 97 != 0, product).otherwise(F.lit(-1)).alias("product_id"),
            F.sum("l_quantity").cast("bigint").alias("quantity"),
            F.max("l_shipdate").alias("loaded_at"),
        )
        return lines.select(
            F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("id"),
            "product_id",
            F.col("l_orderkey").alias("order_id"),
            "quantity",
            "loaded_at",
        )

    # ---- jaffle shop ----

    def raw_orders(self) -> DataFrame:
        total = _cents("o_totalprice")
        tax = F.floor(total * 8 / 108).cast("bigint")
        seconds = F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
        return self.raw("orders").select(
            _text("o_orderkey").alias("id"),
            _text("o_custkey").alias("customer"),
            (F.col("o_orderdate") + seconds).alias("ordered_at"),
            _text(F.col("o_custkey") % 27).alias("store_id"),
            (total - tax).alias("subtotal"),
            tax.alias("tax_paid"),
            total.alias("order_total"),
        )

    def raw_items(self) -> DataFrame:
        parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
        return scan_source(self.spark, self.root, "lineitem").select(
            F.concat_ws("-", *[_text(c) for c in parts]).alias("id"),
            _text("l_orderkey").alias("order_id"),
            _text("l_partkey").alias("sku"),
        )

    def raw_stores(self) -> DataFrame:
        return self.raw("nation").select(
            _text("n_nationkey").alias("id"),
            F.col("n_name").alias("name"),
            (F.lit("2016-09-01 23:59:59").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("n_nationkey"))).alias(
                "opened_at"
            ),
            ((F.col("n_nationkey") % 10).cast("decimal(4,2)") * F.lit("0.01").cast("decimal(3,2)"))
            .cast("decimal(6,4)")
            .alias("tax_rate"),
        )

    def raw_products(self) -> DataFrame:
        kind = F.when(F.col("p_size") % 3 == 0, "jaffle").when(F.col("p_size") % 3 == 1, "beverage")
        return self.raw("part").select(
            _text("p_partkey").alias("sku"),
            F.col("p_name").alias("name"),
            kind.alias("type"),
            _cents("p_retailprice").alias("price"),
            F.col("p_type").alias("description"),
        )

    def raw_customers(self) -> DataFrame:
        """Every fiftieth customer has no name."""
        return self.raw("customer").select(
            _text("c_custkey").alias("id"), F.when(F.col("c_custkey") % 50 != 49, F.col("c_name")).alias("name")
        )

    def raw_supplies(self) -> DataFrame:
        """One supply per supplier and part met in the order lines, at a tenth of the part's price."""
        pairs = scan_source(self.spark, self.root, "lineitem").select("l_suppkey", "l_partkey").distinct()
        part = self.raw("part").select("p_partkey", _cents("p_retailprice").alias("_price"))
        return pairs.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.concat(F.lit("SUP-"), _text("l_suppkey")).alias("id"),
            F.concat(F.lit("supply "), _text("l_suppkey")).alias("name"),
            F.floor(F.col("_price") / 10).cast("bigint").alias("cost"),
            (F.col("l_suppkey") % 2 == 0).alias("perishable"),
            _text("l_partkey").alias("sku"),
        )

    def market_data(self) -> DataFrame:
        """Monthly market totals: three times what the orders amounted to two months before."""
        urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        cents = _cents("o_totalprice")
        return (
            self.raw("orders")
            .withColumn("_later", F.col("o_orderdate") + F.make_ym_interval(F.lit(0), F.lit(2)))
            .groupBy(trunc_month("_later").alias("report_month"))
            .agg(
                (3 * F.sum(F.when(urgent, cents).otherwise(0))).alias("food_sales"),
                (3 * F.sum(F.when(urgent, 0).otherwise(cents))).alias("beverage_sales"),
                (3 * F.sum(cents)).alias("total_sales"),
            )
        )

    def holidays(self) -> DataFrame:
        """26 January, 25 April and 25 December of the years with orders."""
        days = self.order_days()
        listed = F.date_format("date_day", "MM-dd").isin("01-26", "04-25", "12-25")
        return days.filter(listed).select(F.col("date_day").alias("holiday_date"))

    # ---- inventory, lineage and logs ----

    def tables(self) -> DataFrame:
        """One relation per part."""
        k = F.col("p_partkey")
        kinds = ["MANAGED", "VIEW", "STREAMING_TABLE", "MATERIALIZED_VIEW", "EXTERNAL", "FOREIGN"]
        return self.raw("part").select(
            F.lit("analytics").alias("table_catalog"),
            F.concat(F.when(k % 2 == 0, F.lit("dev_")).otherwise(F.lit("Prod_")), _text(k % 50)).alias("table_schema"),
            F.concat(F.lit("tbl_"), _text(k)).alias("table_name"),
            F.element_at(F.array(*[F.lit(x) for x in kinds]), (F.col("p_size") % 6 + 1).cast("int")).alias("table_type"),
            F.concat(F.lit("\n"), F.col("p_name"), F.lit("\n")).alias("comment"),
        )

    def expected_models(self) -> DataFrame:
        """Two thirds of the relations, in another spelling."""
        t = self.tables()
        name = F.concat_ws(".", "table_catalog", F.lower("table_schema"), F.upper("table_name"))
        number = F.substring_index("table_name", "_", -1).cast("bigint")
        return t.filter(number % 3 != 0).select(name.alias("relation_name"))

    def schemata(self) -> DataFrame:
        """Schemas numbered by the customers, and one system schema."""
        k = F.col("c_custkey")
        name = F.concat(F.when(k % 2 == 0, F.lit("dev_")).otherwise(F.lit("Prod_")), _text(k % 1000))
        return (
            self.raw("customer")
            .select(F.lit("analytics").alias("catalog_name"), F.when(k == 0, F.lit("PUBLIC")).otherwise(name).alias("schema_name"))
            .distinct()
        )

    def columns(self) -> DataFrame:
        """One column per part and line number met in the order lines; upper-case names on even parts."""
        name = F.concat(F.lit("col_"), _text("l_linenumber"))
        return (
            self.raw("lineitem")
            .groupBy("l_partkey", "l_linenumber")
            .agg(F.max("l_tax").alias("_tax"))
            .select(
                F.concat(F.lit("sch_"), _text(F.col("l_partkey") % 7)).alias("table_schema"),
                F.concat(F.lit("tbl_"), _text(F.floor(F.col("l_partkey") / 2).cast("bigint"))).alias("table_name"),
                F.when(F.col("l_partkey") % 2 == 0, F.upper(name)).otherwise(name).alias("column_name"),
                F.when(F.col("l_linenumber") % 2 == 0, F.lit("bigint")).otherwise(F.lit("string")).alias("full_data_type"),
                F.concat(F.lit("tax "), _text("_tax"), F.lit("\n")).alias("comment"),
                F.when(F.col("_tax") > 0, F.lit("YES")).otherwise(F.lit("NO")).alias("is_nullable"),
            )
        )

    def column_tags(self) -> DataFrame:
        name = F.concat(F.lit("col_"), _text("l_linenumber"))
        return self.raw("lineitem").select(
            F.lit("analytics").alias("catalog_name"),
            F.concat(F.lit("sch_"), _text(F.col("l_partkey") % 7)).alias("schema_name"),
            F.concat(F.lit("tbl_"), _text(F.floor(F.col("l_partkey") / 2).cast("bigint"))).alias("table_name"),
            F.when(F.col("l_partkey") % 2 == 0, F.upper(name)).otherwise(name).alias("column_name"),
            F.concat(F.lit("tag_"), F.col("l_returnflag")).alias("tag_name"),
            F.concat(F.col("l_linestatus"), _text(F.col("l_suppkey") % 10)).alias("tag_value"),
        )

    def described_columns(self) -> DataFrame:
        """Lower-case column names with two texts each, missing for every fifth line number; in every fifth table the
        upper-case names have texts of their own."""
        c = self.columns().select("table_name", "column_name").distinct()
        lower = c.select("table_name", F.lower("column_name").alias("column_name")).distinct().filter(~F.col("column_name").endswith("5"))
        number = F.substring_index("table_name", "_", -1).cast("bigint")
        upper = c.filter((number % 5 == 0) & (F.col("column_name") != F.lower("column_name")))
        texts = lower.select("table_name", "column_name", F.concat_ws(" of ", "column_name", "table_name").alias("column_description"))
        again = lower.select("table_name", "column_name", F.lit("repeated").alias("column_description"))
        exact = upper.select("table_name", "column_name", F.explode(F.array(F.lit("spelled exactly"), F.lit("spelled so again"), F.lit(None))).alias("column_description"))
        return texts.unionByName(again).unionByName(exact)

    def relations(self) -> DataFrame:
        """Relations for the lineage: every fifth size is stored, the rest are views."""
        return self.raw("part").select(
            F.concat(F.lit("rel_"), _text("p_partkey")).alias("name"), (F.col("p_size") % 5 == 0).alias("is_stored")
        )

    def edges(self) -> DataFrame:
        """Relation i feeds 2i, 2i+1 and i+7, as far as they exist."""
        part = self.raw("part").select(F.col("p_partkey").alias("i"))
        top = part.agg(F.max("i")).scalar()
        j = F.explode(F.array(F.col("i") * 2, F.col("i") * 2 + 1, F.col("i") + 7))
        arcs = part.select("i", j.alias("j")).filter((F.col("j") <= top) & (F.col("j") != F.col("i")))
        return arcs.select(
            F.concat(F.lit("rel_"), _text("i")).alias("parent"), F.concat(F.lit("rel_"), _text("j")).alias("child")
        )

    def desired_grants(self) -> DataFrame:
        """One row per customer, as a model: its nation is the schema, roles by segment, some none."""
        segment = F.lower("c_mktsegment")
        roles = F.when(F.col("c_custkey") % 9 == 0, F.array().cast("array<string>")).otherwise(
            F.array(segment, F.concat(F.lit("team_"), _text(F.col("c_custkey") % 11)))
        )
        return self.raw("customer").select(
            F.concat(F.lit("nation_"), _text("c_nationkey")).alias("schema_name"), roles.alias("roles")
        )

    def held_grants(self) -> DataFrame:
        """One row per supplier; the schemas are numbered from 5, so some are no customer's, and some customers' lack grants."""
        return self.raw("supplier").select(
            F.concat(F.lit("nation_"), _text(F.col("s_nationkey") + 5)).alias("schema_name"),
            F.concat(F.lit("team_"), _text(F.col("s_suppkey") % 17)).alias("role"),
            F.when(F.col("s_suppkey") % 3 == 0, F.lit("SELECT")).otherwise(F.lit("USAGE")).alias("privilege"),
        )

    def views(self) -> DataFrame:
        """View ``int.v_<part>`` reads base table ``t_<size mod 10>``, even parts also the next one."""
        k = F.col("p_partkey")
        first = F.col("p_size") % 10
        below = F.when(k % 2 == 0, F.array(first, (F.col("p_size") + 1) % 10)).otherwise(F.array(first))
        return self.raw("part").select(
            F.concat(F.lit("int.v_"), _text(k)).alias("view_name"), F.explode(below).alias("_t")
        ).select("view_name", F.concat(F.lit("t_"), _text("_t")).alias("table_name"))

    def query_log(self) -> DataFrame:
        """One query per event; the text names one view, in mixed case, and mentions a second."""
        e = F.col("event_id")
        text = F.concat(
            F.lit("SELECT count(*) FROM Analytics.INT.V_"), _text(e % 173),
            F.lit(" a JOIN my_int.v_"), _text(e % 19), F.lit("x b ON a.id = b.id"),
        )
        return self.raw("events").select(
            F.col("event_id").alias("query_id"),
            text.alias("query_text"),
            F.col("ts").alias("started_at"),
            (F.round(F.col("value") * 100).cast("bigint") * 1048576).alias("scanned_bytes"),
        )

    def odd_views(self) -> DataFrame:
        """Views with names of other scripts, hyphens, blanks, dots and quotes, one per part."""
        k = _text("p_partkey")
        kind = F.col("p_partkey") % 4
        name = F.when(kind == 0, F.concat(F.lit("größe.v_"), k)).when(kind == 1, F.concat(F.lit("int.v-"), k))
        name = name.when(kind == 2, F.concat(F.lit('my int.v "'), k, F.lit('"'))).otherwise(F.concat(F.lit("σχ.v."), k, F.lit("`x")))
        return self.raw("part").select(name.alias("view_name"))

    def odd_query_log(self) -> DataFrame:
        """One query per event that names such views, plainly or between quotes with doubled quotes inside."""
        n, form = _text(F.col("event_id") % 401), F.col("event_id") % 3
        plain = F.concat(F.lit("select * from GRÖSSE.V_"), n, F.lit(", Größe.v_"), n, F.lit(" join my_int.V-"), n, F.lit(" on 1.5 = a.b"))
        double = F.concat(F.lit('SELECT x."y.z", "My INT"."V ""'), n, F.lit('""" FROM "größe".v_'), n, F.lit(" t"))
        back = F.concat(F.lit("with c as (select `a``b`.q from `ΣΧ`.`v."), n, F.lit("``x`) select 'int.v-"), n, F.lit("' from \"int\"."), n)
        text = F.when(form == 0, plain).when(form == 1, double).otherwise(back)
        return self.raw("events").select(F.col("event_id").alias("query_id"), text.alias("query_text"))

    def query_scans(self) -> DataFrame:
        """Tables each query scanned: half of the ten base tables, starting anywhere."""
        i = F.explode(F.sequence(F.lit(0), F.lit(4)))
        return self.raw("events").select(F.col("event_id").alias("query_id"), "user_id", i.alias("i")).select(
            "query_id", F.concat(F.lit("t_"), _text((F.col("user_id") + F.col("i")) % 10)).alias("table_name")
        )

    def load_log(self) -> DataFrame:
        """One load statement per event; a third of the tables only ever grow."""
        kinds = {"view": "insert", "signup": "CTAS", "click": "Update", "error": "delete", "purchase": "MERGE"}
        pairs = [F.lit(x) for kv in kinds.items() for x in kv]
        grows = F.when(F.col("user_id") % 3 == 0, F.lit("INSERT"))
        return self.raw("events").select(
            F.concat(F.lit("tab_"), _text("user_id")).alias("table_name"),
            F.col("ts").alias("started_at"),
            F.coalesce(grows, F.create_map(*pairs)[F.col("event_type")]).alias("statement_type"),
        )

    def last_event_day(self) -> Column:
        return self.raw("events").agg(F.max(to_date("ts"))).scalar()

    def table_stats(self) -> DataFrame:
        """Facts per part, as a table: size and rows from its order lines."""
        per_part = self.raw("lineitem").groupBy("l_partkey").agg(
            F.sum(F.col("l_quantity")).cast("bigint").alias("_q"), F.count(F.lit(1)).alias("_n")
        )
        k = F.col("l_partkey")
        return per_part.select(
            F.concat(F.lit("tab_"), _text(k)).alias("table_name"),
            (F.col("_q") * 7).alias("size_mb"),
            (F.col("_n") * 100_000).alias("row_count"),
            F.when(k % 7 != 0, k % 3 == 0).alias("is_append_mostly"),
            F.when(k % 2 == 0, F.lit("event_date")).alias("event_time_column"),
            F.when(k % 5 < 3, F.lit("id")).alias("unique_column"),
            (k % 11 == 0).alias("sort_key_is_date"),
        )

