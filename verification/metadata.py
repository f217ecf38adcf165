"""Inventory, lineage and workload analyses over tables derived from the given data."""


from pyspark.sql import functions as F

from martmill.operators import catalog, lineage, workload
from verification import query
from verification.sqltext import d2, with_

TABLES = """tables AS (
  SELECT 'analytics' AS table_catalog, CASE WHEN p_partkey % 2 = 0 THEN 'dev_' ELSE 'Prod_' END || (p_partkey % 50) AS table_schema,
    'tbl_' || p_partkey AS table_name, p_partkey, p_name AS comment,
    ['MANAGED', 'VIEW', 'STREAMING_TABLE', 'MATERIALIZED_VIEW', 'EXTERNAL', 'FOREIGN'][p_size % 6 + 1] AS table_type
  FROM part)"""


@query(with_(TABLES) + """SELECT 'drop ' || word || ' ' || rel || ';' AS drop_commands, rel AS relation_name FROM (
  SELECT CASE WHEN table_type IN ('MANAGED', 'STREAMING_TABLE') THEN 'TABLE' WHEN table_type = 'VIEW' THEN 'VIEW'
      WHEN table_type = 'MATERIALIZED_VIEW' THEN 'MATERIALIZED VIEW' END AS word,
    '`' || table_catalog || '`.`' || table_schema || '`.`' || table_name || '`' AS rel
  FROM tables WHERE p_partkey % 3 = 0 AND table_schema LIKE 'dev\\_%' ESCAPE '\\') WHERE word IS NOT NULL""")
def deprecated_relations(g):
    return catalog.deprecated_relations(g.tables(), g.expected_models(), dev_prefix="DEV_")


@query(with_(TABLES, """schemata AS (SELECT DISTINCT CASE WHEN c_custkey = 0 THEN 'PUBLIC'
  ELSE CASE WHEN c_custkey % 2 = 0 THEN 'dev_' ELSE 'Prod_' END || (c_custkey % 1000) END AS s FROM customer)""") + """
SELECT 'DROP SCHEMA `analytics`.`' || s || '`;' AS drop_commands, '`analytics`.`' || s || '`' AS schema_name
FROM (SELECT s FROM schemata WHERE s <> 'PUBLIC' EXCEPT SELECT table_schema FROM tables)""")
def empty_schemas(g):
    return catalog.empty_schemas(g.schemata(), g.tables())


@query(with_(TABLES) + """SELECT DISTINCT table_schema, table_name,
  CASE table_type WHEN 'MATERIALIZED_VIEW' THEN 'materialized_view' ELSE lower(table_type) END AS table_type, comment AS table_description
FROM tables WHERE table_schema ILIKE 'PROD%' AND table_name ILIKE 'TBL%1' AND NOT table_name ILIKE '%11'""")
def describe_tables(g):
    return catalog.describe_tables(g.tables(), "prod%", "TBL%1", exclude="%11")


COLUMNS = """cols AS (
  SELECT 'sch_' || (l_partkey % 7) AS table_schema, 'tbl_' || (l_partkey // 2) AS table_name,
    CASE WHEN l_partkey % 2 = 0 THEN 'COL_' || l_linenumber ELSE 'col_' || l_linenumber END AS column_name,
    CASE WHEN l_linenumber % 2 = 0 THEN 'bigint' ELSE 'string' END AS full_data_type,
    'tax ' || max(CAST(l_tax AS DECIMAL(4,2))) AS comment, CASE WHEN max(l_tax) > 0 THEN 'YES' ELSE 'NO' END AS is_nullable
  FROM lineitem GROUP BY l_partkey, l_linenumber)"""


@query(with_(COLUMNS, """tag AS (
  SELECT 'sch_' || (l_partkey % 7) AS table_schema, 'tbl_' || (l_partkey // 2) AS table_name,
    CASE WHEN l_partkey % 2 = 0 THEN 'COL_' || l_linenumber ELSE 'col_' || l_linenumber END AS column_name,
    'tag_' || l_returnflag AS k, max(l_linestatus || (l_suppkey % 10)) AS v
  FROM lineitem GROUP BY 1, 2, 3, 4)""", """tags AS (SELECT table_schema, table_name, column_name,
    '{' || string_agg('"' || k || '":"' || v || '"', ',' ORDER BY k) || '}' AS column_tags FROM tag GROUP BY 1, 2, 3)""") + """
SELECT table_schema, table_name, column_name, full_data_type AS column_data_type, comment AS column_description,
  is_nullable AS column_is_nullable, column_tags
FROM cols LEFT JOIN tags USING (table_schema, table_name, column_name)""")
def describe_columns(g):
    return catalog.describe_columns(g.columns(), g.column_tags())


@query(with_(COLUMNS) + """SELECT table_name, lower(column_name) AS column_name,
  CASE WHEN column_name <> lower(column_name) AND CAST(split_part(table_name, '_', 2) AS BIGINT) % 5 = 0 THEN 'spelled exactly'
    WHEN lower(column_name) LIKE '%5' THEN '' ELSE lower(column_name) || ' of ' || table_name END AS column_description FROM cols""")
def column_descriptions(g):
    return catalog.column_descriptions(g.columns(), g.described_columns())


@query("""WITH d AS (SELECT 'nation_' || c_nationkey AS schema_name, CASE WHEN c_custkey % 9 = 0 THEN []
    ELSE [lower(c_mktsegment), 'team_' || (c_custkey % 11)] END AS roles FROM customer),
  want AS (SELECT DISTINCT schema_name, unnest(roles) AS role FROM d),
  held AS (SELECT DISTINCT 'nation_' || (s_nationkey + 5) AS schema_name, 'team_' || (s_suppkey % 17) AS role FROM supplier
           WHERE s_suppkey % 3 <> 0 AND 'nation_' || (s_nationkey + 5) IN (SELECT schema_name FROM d))
SELECT 'grant' AS action, * FROM (SELECT * FROM want EXCEPT SELECT * FROM held)
UNION ALL SELECT 'revoke', * FROM (SELECT * FROM held EXCEPT SELECT * FROM want)""")
def grant_drift(g):
    return catalog.grant_drift(g.desired_grants(), g.held_grants(), "USAGE")


EDGES = """arcs AS (SELECT i, j FROM (SELECT p_partkey AS i, unnest([p_partkey * 2, p_partkey * 2 + 1, p_partkey + 7]) AS j FROM part)
  WHERE j <= (SELECT max(p_partkey) FROM part) AND i <> j)"""


@query(with_(EDGES) + "SELECT 'rel_' || i AS parent, count(DISTINCT j) AS downstream_count, count(DISTINCT j) >= 2 AS is_candidate FROM arcs GROUP BY i")
def downstream_count(g):
    return lineage.downstream_count(g.edges())


@query("WITH RECURSIVE " + EDGES + """,
  stored AS (SELECT p_partkey AS k, p_size % 5 = 0 AS is_stored FROM part),
  hop AS (
    SELECT a.i AS v, 1 AS n FROM arcs a JOIN stored s ON a.j = s.k AND s.is_stored JOIN stored p ON a.i = p.k AND NOT p.is_stored
    UNION
    SELECT a.i, h.n + 1 FROM hop h JOIN arcs a ON a.j = h.v JOIN stored p ON a.i = p.k AND NOT p.is_stored WHERE h.n < 60)
SELECT 'rel_' || v AS view_name, min(n) AS min_hops_to_table FROM hop GROUP BY v""")
def view_chain_hops(g):
    return lineage.view_chain_hops(g.edges(), g.relations())


STATS = f"""stats AS (SELECT l_partkey AS k, CAST(sum({d2('l_quantity')}) AS BIGINT) * 7 AS size_mb, count(*) * 100000 AS row_count
  FROM lineitem GROUP BY 1)"""


@query(with_(STATS) + """SELECT table_name, tier, CASE tier WHEN 0 THEN 'table' WHEN 1 THEN 'microbatch' WHEN 2 THEN 'append' WHEN 3 THEN 'merge'
  WHEN 4 THEN 'delete+insert' ELSE 'unclassified' END AS strategy, CASE WHEN tier = 3 THEN 'id' END AS unique_key
FROM (SELECT 'tab_' || k AS table_name, CASE WHEN size_mb < 1000 THEN 0
    WHEN k % 7 <> 0 AND k % 3 = 0 AND k % 2 = 0 AND row_count > 1000000 THEN 1
    WHEN k % 7 <> 0 AND k % 3 = 0 AND k % 2 <> 0 AND size_mb > 1000 THEN 2
    WHEN NOT (k % 7 <> 0 AND k % 3 = 0) AND size_mb BETWEEN 1000 AND 5000 AND k % 5 < 3 AND k % 11 <> 0 THEN 3
    WHEN NOT (k % 7 <> 0 AND k % 3 = 0) AND size_mb > 5000 AND k % 5 >= 3 THEN 4 END AS tier FROM stats)""")
def incremental_tier(g):
    return workload.incremental_tier(g.table_stats())


LOG = """log AS (SELECT event_id AS query_id, CAST(ts AS DATE) AS day, user_id, CAST(round(value * 100) AS BIGINT) * 1048576 AS bytes,
  'SELECT count(*) FROM Analytics.INT.V_' || (event_id % 173) || ' a JOIN my_int.v_' || (event_id % 19) || 'x b ON a.id = b.id' AS query_text
  FROM events), today AS (SELECT max(CAST(ts AS DATE)) AS d FROM events)"""
VIEWS = "views AS (SELECT 'int.v_' || p_partkey AS view_name, p_partkey, p_size FROM part)"
MATCHED = """matched AS (SELECT query_id, view_name, bytes FROM log, views, today
  WHERE contains(lower(query_text), lower(view_name)) AND day > d - 7 AND day <= d
  AND (user_id % 10 + 10 - p_size % 10) % 10 IN (0, 6, 7, 8, 9)
  AND (p_partkey % 2 <> 0 OR (user_id % 10 + 10 - (p_size + 1) % 10) % 10 IN (0, 6, 7, 8, 9)))"""


@query(with_(LOG, VIEWS) + "SELECT query_id, view_name FROM log, views WHERE contains(lower(query_text), lower(view_name))")
def join_text_match(g):
    return workload.join_text_match(g.query_log(), g.views().select("view_name").distinct())


# Views of other scripts and signs, and texts that name them plainly, in double quotes or in backticks.
ODD = '''odd_views AS (SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'größe.v_' || p_partkey WHEN 1 THEN 'int.v-' || p_partkey
    WHEN 2 THEN 'my int.v "' || p_partkey || '"' ELSE 'σχ.v.' || p_partkey || '`x' END AS view_name FROM part),
  odd_log AS (SELECT event_id AS query_id, CASE event_id % 3
      WHEN 0 THEN 'select * from GRÖSSE.V_' || n || ', Größe.v_' || n || ' join my_int.V-' || n || ' on 1.5 = a.b'
      WHEN 1 THEN 'SELECT x."y.z", "My INT"."V ""' || n || '""" FROM "größe".v_' || n || ' t'
      ELSE 'with c as (select `a``b`.q from `ΣΧ`.`v.' || n || '``x`) select \\'\\'int.v-' || n || '\\'\\' from "int".' || n END AS query_text
    FROM (SELECT event_id, event_id % 401 AS n FROM events))'''.replace("\\'\\'", "''")
_BARE = "lower(query_text)"
for _q in ('"', "`"):
    _BARE = f"replace(regexp_replace({_BARE}, '{_q}((?:[^{_q}]|{_q}{_q})*){_q}', '\\1', 'g'), '{_q}{_q}', '{_q}')"


@query(with_(ODD) + f"""SELECT query_id, view_name FROM (SELECT query_id, lower(query_text) AS a, {_BARE} AS b FROM odd_log), odd_views
WHERE contains(a, lower(view_name)) OR contains(b, lower(view_name))""")
def join_text_match_any_script(g):
    """Names with hyphens, blanks, quotes and letters beyond ASCII; quoted parts keep doubled quotes."""
    return workload.join_text_match(g.odd_query_log(), g.odd_views())


def _attribution(g):
    return workload.query_view_attribution(g.query_log(), g.query_scans(), g.views(), g.last_event_day(), carry=["scanned_bytes"])


@query(with_(LOG, VIEWS, MATCHED) + "SELECT query_id, view_name FROM matched")
def query_view_attribution(g):
    return _attribution(g).select("query_id", "view_name")


@query(with_(LOG, VIEWS, MATCHED) + "SELECT view_name, count(*) AS query_count, CAST(sum(bytes) AS DOUBLE) / 1073741824 AS total_gb_rescanned FROM matched GROUP BY 1")
def rescanned_gb(g):
    return workload.rescanned_gb(_attribution(g))


@query(with_(LOG, VIEWS, MATCHED, EDGES, "down AS (SELECT i, count(DISTINCT j) AS n FROM arcs GROUP BY i)",
             "used AS (SELECT view_name, count(*) AS n FROM matched GROUP BY 1)") + """
SELECT v.view_name, coalesce(down.n, 0) AS downstream_count, coalesce(used.n, 0) AS query_count,
  coalesce(down.n, 0) >= 3 OR coalesce(used.n, 0) >= 1 AS is_candidate
FROM views v LEFT JOIN down ON down.i = v.p_partkey LEFT JOIN used ON used.view_name = v.view_name""")
def materialization_candidates(g):
    """Views with three or more children, or with a query in the last week."""
    named = [F.replace(c, F.lit("rel_"), F.lit("int.v_")).alias(c) for c in ("parent", "child")]
    edges = g.edges().select(*named)
    traffic = workload.rescanned_gb(_attribution(g))
    return lineage.materialization_candidates(edges, g.views().select("view_name").distinct(), traffic, min_children=3)


LOADS = """loads AS (SELECT 'tab_' || user_id AS table_name, CAST(ts AS DATE) AS day, CASE WHEN user_id % 3 = 0 THEN 'INSERT'
  ELSE CASE event_type WHEN 'view' THEN 'INSERT' WHEN 'signup' THEN 'CTAS' WHEN 'click' THEN 'UPDATE' WHEN 'error' THEN 'DELETE' ELSE 'MERGE' END
  END AS statement_type FROM events)"""
_DML = "(SELECT * FROM loads WHERE day > (SELECT max(day) - 14 FROM loads))"


@query(with_(LOADS) + f"SELECT table_name, CAST(day AS TIMESTAMP) AS day, statement_type, count(*) AS statements FROM {_DML} GROUP BY 1, 2, 3")
def dml_pattern_daily(g):
    return workload.dml_pattern_daily(g.load_log(), g.last_event_day())


@query(with_(LOADS) + f"SELECT table_name, bool_and(statement_type IN ('INSERT', 'CTAS')) AS is_append_mostly FROM {_DML} GROUP BY 1")
def append_mostly(g):
    return workload.append_mostly(workload.dml_pattern_daily(g.load_log(), g.last_event_day()))


