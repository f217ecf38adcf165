import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martmill.operators import catalog, lineage, workload


@pytest.fixture
def tables(spark):
    return spark.createDataFrame(
        [
            ("cat", "dev_a", "kept", "MANAGED", "x"),
            ("cat", "DEV_a", "Old", "MANAGED", "\nnote\n"),
            ("cat", "dev_a", "flow", "STREAMING_TABLE", None),
            ("cat", "dev_b", "seen", "VIEW", None),
            ("cat", "dev_b", "mat", "MATERIALIZED_VIEW", None),
            ("cat", "dev_b", "far", "EXTERNAL", None),
            ("cat", "devxa", "other", "MANAGED", None),
            ("cat", "information_schema", "tables", "VIEW", None),
        ],
        "table_catalog string, table_schema string, table_name string, table_type string, comment string",
    )


def test_deprecated_relations(spark, tables, rows):
    expected = spark.createDataFrame([("CAT.dev_A.KEPT",)], "n string")
    got = rows(catalog.deprecated_relations(tables, expected, dev_prefix="dev_"))
    assert got == [
        ("drop MATERIALIZED VIEW `cat`.`dev_b`.`mat`;", "`cat`.`dev_b`.`mat`"),
        ("drop TABLE `cat`.`DEV_a`.`Old`;", "`cat`.`DEV_a`.`Old`"),
        ("drop TABLE `cat`.`dev_a`.`flow`;", "`cat`.`dev_a`.`flow`"),
        ("drop VIEW `cat`.`dev_b`.`seen`;", "`cat`.`dev_b`.`seen`"),
    ]
    assert "devxa" in str(rows(catalog.deprecated_relations(tables, expected)))


def test_empty_schemas(spark, tables, rows):
    schemata = spark.createDataFrame(
        [("cat", s) for s in ("dev_a", "dev_c", "PUBLIC", "public", "prod")], "catalog_name string, schema_name string"
    )
    got = rows(catalog.empty_schemas(schemata, tables), "schema_name")
    assert got == [("`cat`.`dev_c`",), ("`cat`.`prod`",), ("`cat`.`public`",)]
    assert rows(catalog.empty_schemas(schemata, tables, "dev"), "drop_commands") == [("DROP SCHEMA `cat`.`dev_c`;",)]


def test_describe_tables(tables, rows):
    got = rows(catalog.describe_tables(tables, "DEV_A", "%", exclude="f%"))
    # In a pattern, unlike in a prefix, an underscore stands for any character.
    assert got == [("DEV_a", "Old", "managed", "note"), ("dev_a", "kept", "managed", "x"), ("devxa", "other", "managed", None)]
    got = rows(catalog.describe_tables(tables, "%", "nothing", names=["mat", "far"]), "table_name", "table_type")
    assert got == [("far", "external"), ("mat", "materialized_view")]


def test_describe_columns_keeps_schemas_apart(spark, rows):
    columns = spark.createDataFrame(
        [("s1", "t", "c", "int", "text\n", "YES"), ("s2", "t", "c", "int", None, "NO")],
        "table_schema string, table_name string, column_name string, full_data_type string, comment string, is_nullable string",
    )
    tags = spark.createDataFrame(
        [("k", "s1", "t", "c", "pii", "yes"), ("k", "s1", "t", "c", "owner", "me")],
        "catalog_name string, schema_name string, table_name string, column_name string, tag_name string, tag_value string",
    )
    got = rows(catalog.describe_columns(columns, tags), "table_schema", "column_description", "column_tags")
    assert got == [("s1", "text", '{"owner":"me","pii":"yes"}'), ("s2", None, None)]


def test_column_descriptions_fall_back_to_lower_case(spark, rows):
    columns = spark.createDataFrame([("t", "ID"), ("t", "Name"), ("t", "x"), ("t", "OPEN")], "table_name string, column_name string")
    texts = spark.createDataFrame(
        [("t", "ID", "exact"), ("t", "id", "lower"), ("t", "name", "lower"), ("u", "x", "other"), ("t", "OPEN", None), ("t", "open", "z")],
        "table_name string, column_name string, column_description string",
    )
    got = rows(catalog.column_descriptions(columns, texts), "column_name", "column_description")
    assert got == [("id", "exact"), ("name", "lower"), ("open", ""), ("x", "")]


def test_grant_drift(spark, rows):
    desired = spark.createDataFrame(
        [("s", ["a", "b"]), ("s", ["b", "c"]), ("t", []), ("u", None)], "schema_name string, roles array<string>"
    )
    actual = spark.createDataFrame(
        [("s", "a", "USAGE"), ("s", "z", "USAGE"), ("s", "c", "SELECT"), ("t", "q", "USAGE"), ("v", "a", "USAGE")],
        "schema_name string, role string, privilege string",
    )
    assert rows(catalog.grant_drift(desired, actual, "USAGE")) == [
        ("grant", "s", "b"), ("grant", "s", "c"), ("revoke", "s", "z"), ("revoke", "t", "q"),
    ]


# The dependency graph of the order-line warehouse: parent, child.
EDGES = [
    ("stg_customers", "int_customer_geo"), ("stg_nations", "int_customer_geo"), ("stg_regions", "int_customer_geo"),
    ("stg_lineitem", "int_lineitem_enriched"), ("stg_orders", "int_lineitem_enriched"),
    ("stg_customers", "int_lineitem_enriched"), ("stg_orders", "int_order_priorities"),
    ("int_customer_geo", "int_order_priorities"), ("int_order_priorities", "int_order_priorities_summary"),
    ("int_order_priorities_summary", "agg_order_priority_breakdown"), ("int_customer_geo", "dim_customers"),
    ("int_customer_geo", "agg_customer_revenue"), ("stg_orders", "agg_customer_revenue"),
    ("int_lineitem_enriched", "fct_lineitem"), ("int_lineitem_enriched", "agg_daily_sales"),
    ("stg_orders", "fct_orders"), ("int_customer_geo", "fct_orders"),
]


def _graph(spark, edges):
    names = {n for e in edges for n in e}
    stored = [(n, n.startswith(("dim_", "agg_", "fct_", "T"))) for n in sorted(names)]
    return spark.createDataFrame(edges, "parent string, child string"), spark.createDataFrame(stored, "name string, is_stored boolean")


def test_downstream_count_golden(spark):
    edges, _ = _graph(spark, EDGES + EDGES[:1])
    got = {r["parent"]: (r["downstream_count"], r["is_candidate"]) for r in lineage.downstream_count(edges).collect()}
    assert got["int_customer_geo"] == (4, True)
    assert got["int_lineitem_enriched"] == (2, True)
    assert got["int_order_priorities"] == (1, False)
    assert got["int_order_priorities_summary"] == (1, False)


def test_candidates_golden(spark):
    edges, relations = _graph(spark, EDGES)
    views = relations.filter("NOT is_stored").withColumnRenamed("name", "view_name")
    traffic = spark.createDataFrame([("int_order_priorities", 3)], "view_name string, query_count bigint")
    got = {r["view_name"]: r["is_candidate"] for r in lineage.materialization_candidates(edges, views, traffic.limit(0)).collect()}
    assert got["int_customer_geo"] and got["int_lineitem_enriched"]
    assert not got["int_order_priorities"] and not got["int_order_priorities_summary"]
    got = {r["view_name"]: r["is_candidate"] for r in lineage.materialization_candidates(edges, views, traffic).collect()}
    assert got["int_order_priorities"] and not got["int_order_priorities_summary"]


@pytest.mark.parametrize("steps", [1, 2, 4])
def test_view_chain_hops_golden(spark, steps):
    edges, relations = _graph(spark, EDGES)
    got = dict(lineage.view_chain_hops(edges, relations, steps_per_round=steps).collect())
    assert got["int_order_priorities"] == 2
    assert got["int_order_priorities_summary"] == got["int_lineitem_enriched"] == got["int_customer_geo"] == 1
    assert "dim_customers" not in got


@pytest.mark.parametrize("seed", [1, 2])
def test_view_chain_hops_on_cyclic_graphs(spark, seed):
    rng = random.Random(seed)
    names = [f"v{i}" for i in range(40)] + ["T1", "T2"]
    edges = [(f"v{rng.randrange(40)}", rng.choice(names)) for _ in range(55)]
    best = {}
    frontier = {n for n in names if n.startswith("T")}
    hops = 0
    while frontier:
        hops += 1
        frontier = {p for p, c in edges if c in frontier and p not in best}
        best.update(dict.fromkeys(frontier, hops))
    e, r = _graph(spark, edges)
    assert dict(lineage.view_chain_hops(e, r).collect()) == best


def test_view_chains_and_rings(spark):
    """Long chains of single views, a ring that nothing leaves, a chain into it, and a view below two chains of unlike length."""
    chain = [(f"c{i}", f"c{i + 1}") for i in range(37)] + [("c37", "T1")]
    ring = [(f"r{i}", f"r{(i + 1) % 5}") for i in range(5)] + [("into", "r2"), ("v", "v"), ("v", "c30")]
    fork = [("f", "c0"), ("f", "d0"), *[(f"d{i}", f"d{i + 1}") for i in range(50)], ("d50", "T2"), ("g", "f"), ("lost", "nowhere")]
    e, r = _graph(spark, chain + ring + fork + [("r9", "r3"), ("r9", "c35")])
    got = dict(lineage.view_chain_hops(e, r).collect())
    assert got == {f"c{i}": 38 - i for i in range(38)} | {f"d{i}": 51 - i for i in range(51)} | {"f": 39, "g": 40, "v": 9, "r9": 4}


def test_view_chain_depth_is_bounded(spark):
    chain = [(f"v{i}", f"v{i + 1}") for i in range(6)] + [("v6", "T")]
    e, r = _graph(spark, chain)
    assert dict(lineage.view_chain_hops(e, r).collect())["v0"] == 7
    with pytest.raises(RuntimeError):
        lineage.view_chain_hops(e, r, max_depth=4)


STATS = "table_name string, size_mb int, row_count bigint, is_append_mostly boolean, event_time_column string, unique_column string, sort_key_is_date boolean"


def test_incremental_tier_golden(spark):
    stats = spark.createDataFrame(
        [
            ("dim_regions", 1, 5, True, None, "region_id", None),
            ("dim_customers", 250, 1_500_000, True, None, "customer_id", None),
            ("fct_orders", 1700, 15_000_000, False, None, "order_id", False),
            ("fct_lineitem", 7000, 60_000_000, True, "event_date", None, True),
            ("no_time", 7000, 60_000_000, True, None, None, True),
            ("history", 7000, 60_000_000, False, "event_date", None, None),
            ("no_key", 2000, 10, False, None, None, None),
            ("date_sorted", 2000, 10, False, None, "id", True),
            ("few_rows", 2000, 1_000_000, True, "event_date", None, None),
            ("unknown_size", None, 10, None, None, None, None),
        ],
        STATS,
    )
    got = {r["table_name"]: (r["tier"], r["strategy"], r["unique_key"]) for r in workload.incremental_tier(stats).collect()}
    assert got == {
        "dim_regions": (0, "table", None),
        "dim_customers": (0, "table", None),
        "fct_orders": (3, "merge", "order_id"),
        "fct_lineitem": (1, "microbatch", None),
        "no_time": (2, "append", None),
        "history": (4, "delete+insert", None),
        "no_key": (None, "unclassified", None),
        "date_sorted": (None, "unclassified", None),
        "few_rows": (None, "unclassified", None),
        "unknown_size": (None, "unclassified", None),
    }


TEXTS = [
    "select * from db.INT.orders_geo limit 10",
    "select * from int.orders_geo_summary",
    "SELECT a.b FROM print.orders_geo",
    "select 'int . orders_geo'",
    "no names here",
    "int.orders_geo.int.orders_geo",
    "x.int.o",
    "éint.orders_geo",
    None,
]


def test_text_match_is_containment(spark, rows):
    views = ["int.orders_geo", "INT.orders", "int.orders_geo_summary", "t.o", "other.view"]
    q = spark.createDataFrame(list(enumerate(TEXTS)), "query_id int, query_text string")
    v = spark.createDataFrame([(n,) for n in views], "view_name string")
    want = sorted((i, n) for i, text in enumerate(TEXTS) if text for n in views if n.lower() in text.lower())
    assert sorted(tuple(r) for r in workload.join_text_match(q, v).collect()) == want


def test_text_match_on_random_texts(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 3)))
    views = sorted({f"{word()}.{word()}" for _ in range(12)})
    texts = ["".join(rng.choice("aabb..  ") for _ in range(30)) for _ in range(60)]
    q = spark.createDataFrame(list(enumerate(texts)), "query_id int, query_text string")
    v = spark.createDataFrame([(n,) for n in views], "view_name string")
    want = sorted((i, n) for i, t in enumerate(texts) for n in views if n in t)
    assert sorted(tuple(r) for r in workload.join_text_match(q, v).collect()) == want


def test_attribution_needs_text_scans_and_recency(spark, rows):
    at = lambda d: dt.datetime(2024, 1, d, 5)
    queries = spark.createDataFrame(
        [
            (1, "select * from int.geo", at(10), 2**30), (2, "select * from INT.GEO", at(9), 2**29),
            (3, "select 1", at(10), 1), (4, "from int.geo", at(3), 1), (5, "from int.geo", at(10), 1),
        ],
        "query_id int, query_text string, started_at timestamp_ntz, scanned_bytes bigint",
    )
    scans = spark.createDataFrame(
        [(q, t) for q in (1, 2, 3, 4) for t in ("a", "b", "c", "a")] + [(5, "a")], "query_id int, table_name string"
    )
    below = spark.createDataFrame([("int.geo", "a"), ("int.geo", "b"), ("int.geo", "b")], "view_name string, table_name string")
    hits = workload.query_view_attribution(queries, scans, below, dt.date(2024, 1, 10))
    assert rows(hits) == [(1, "int.geo"), (2, "int.geo")]
    assert rows(workload.rescanned_gb(hits, queries)) == [("int.geo", 2, 1.5)]


def test_load_patterns(spark, rows):
    at = lambda d: dt.datetime(2024, 1, d)
    log = spark.createDataFrame(
        [("t", at(20), "insert"), ("t", at(20), "INSERT"), ("t", at(19), "CTAS"), ("u", at(20), "MERGE"), ("u", at(20), "INSERT"),
         ("t", at(6), "DELETE")],
        "table_name string, started_at timestamp_ntz, statement_type string",
    )
    daily = workload.dml_pattern_daily(log, dt.date(2024, 1, 20))
    assert ("t", dt.date(2024, 1, 20), "INSERT", 2) in rows(daily) and daily.count() == 4
    assert rows(workload.append_mostly(daily)) == [("t", True), ("u", False)]


def test_a_long_word_does_not_blow_up(spark):
    q = spark.createDataFrame([(1, "int." + "v" * 100_000)], "query_id int, query_text string")
    v = spark.createDataFrame([("int.vv",)], "view_name string")
    assert workload.join_text_match(q, v).count() == 1


def test_text_match_of_any_identifier(spark, rows):
    views = spark.createDataFrame([("größe.v_1",), ("int.v-1",), ("My S.a \"b\"",), ("x.y.z",), ("s.t`u",), ("nodot",), ("e.",), ("int.v",)], "view_name string")
    texts = [
        "select * from GRÖSSE.V_1, Größe.V_1", 'from "größe"."v_1"', "from `int`.`v-1`", "from my_int.v-12", 'from "my s"."A ""b""" t', "from a.x.y.zed", "from x.y . z", "from s.`t``u`",
        "nodot e. s", "'int.v' || \"int", "1.5", "", None, "." * 50, "é" * 2000 + ".int.v-1",
    ]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id int, query_text string")
    got = rows(workload.join_text_match(queries.withColumn("b", F.col("query_id") * 2), views, carry=["b"]))
    want = {(0, "größe.v_1"), (1, "größe.v_1"), (2, "int.v-1"), (3, "int.v-1"), (4, 'My S.a "b"'), (5, "x.y.z"), (7, "s.t`u"), (14, "int.v-1")}
    want |= {(q, "int.v") for q in (2, 3, 9, 14)}
    assert got == sorted(((q, v, 2 * q) for q, v in want), key=repr)
    assert workload.join_text_match(queries, views.limit(0)).count() == 0


def test_attribution_needs_every_table_of_many(spark, rows):
    """200 tables below a view: several words of bits; one scan short is no use of the view."""
    day = dt.datetime(2024, 1, 8)
    queries = spark.createDataFrame([(1, "from s.wide", day), (2, "from s.wide", day), (3, "from s.slim", day), (4, "from s.slim", day - dt.timedelta(days=9))], "query_id int, query_text string, started_at timestamp_ntz")
    below = [("s.wide", f"t{i}") for i in range(200)] + [("s.slim", "t7"), ("s.slim", "t7"), ("s.slim", "t199")]
    scans = [(1, f"t{i}") for i in range(200)] + [(2, f"t{i}") for i in range(199)] + [(3, "t7"), (3, "t199"), (3, "other"), (4, "t7"), (4, "t199")]
    got = workload.query_view_attribution(
        queries, spark.createDataFrame(scans, "query_id int, table_name string"), spark.createDataFrame(below, "view_name string, table_name string"), dt.date(2024, 1, 8)
    )
    assert rows(got) == [(1, "s.wide"), (3, "s.slim")]


@pytest.mark.parametrize("sent", [workload.SENT_NAMES, 0])
def test_text_match_never_sends_the_texts_to_every_task(spark, rows, monkeypatch, sent):
    """More names than Spark would broadcast, beside texts that look small until they are cut: the names' counted size decides."""
    monkeypatch.setattr(workload, "SENT_NAMES", sent)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        views = spark.range(3000).select(F.concat(F.lit("s.v_"), F.col("id").cast("string"), F.lit("x")).alias("view_name"))
        queries = spark.range(600).select(F.col("id").alias("query_id"), F.concat(F.lit("from S.V_"), (F.col("id") * 7).cast("string"), F.lit("x, t.v_1x")).alias("query_text"))
        out = workload.join_text_match(queries, views)
        got = rows(out)
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert got == sorted(((i, f"s.v_{7 * i}x") for i in range(429)), key=repr)
        assert ("BroadcastHashJoin" in plan) == (sent > 0) and ("SortMergeJoin" in plan) == (sent == 0)
        assert "BuildLeft" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
