"""Jobs over query and load logs, and the load strategy they suggest per table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martmill.operators.ranking import rank_first
from martmill.session import materialise

# Look-back windows in days.
MATERIALIZATION_LOOKBACK_DAYS = 7
INCREMENTAL_LOOKBACK_DAYS = 14
# Size limits of the strategy rules.
MIN_TABLE_MB = 1000
MERGE_MAX_MB = 5000
MICROBATCH_MIN_ROWS = 1_000_000
# Statements that only ever add rows.
APPEND_STATEMENTS = ("INSERT", "CTAS")
# Bytes of view names up to which they go to every task whole; with more, names and texts are shuffled.
SENT_NAMES = 8 * 2**20


def _recent(c: str, as_of: dt.date | Column, days: int) -> Column:
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    day = F.col(c).cast("date")
    return (day > F.date_sub(today, days)) & (day <= today)


def _unquoted(text: Column) -> Column:
    """The text without identifier quotes: a quoted part keeps its content, in which a doubled quote stands for one."""
    for quote in ('"', "`"):
        content = F.regexp_replace(text, f"{quote}((?:[^{quote}]|{quote}{quote})*+){quote}", "$1")
        text = F.replace(content, F.lit(quote * 2), F.lit(quote))
    return text


def join_text_match(queries: DataFrame, views: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Pairs of query and view where the text holds the view's ``schema.name``, ignoring case.

    Containment, as ILIKE '%schema.name%' would find it, in the text as it stands or without its identifier quotes: double
    quotes and backticks are taken off, and a doubled quote between them stands for one. Names may hold any characters of
    any script, the name also dots; the first dot ends the schema. A view name without a dot matches nothing.

    A hit always spans a dot, with the schema at the end of what stands before and the name at the start of what
    follows. So each text is cut at its dots, what follows a dot is looked up by equality once for each
    length that names have, and the schema decides. The texts are read once, and no text meets every view.
    Spark's estimates do not see that texts are cut into many rows, so the join is chosen by the counted bytes of the names.

    ``queries``: ``query_id, query_text`` and the columns to ``carry`` along; ``views``: ``view_name``.
    """
    name = F.lower("view_name")
    schema = F.substring_index(name, ".", 1)
    index = views.select("view_name").distinct().select(
        "view_name", schema.alias("_schema"), F.substr(name, F.length(schema) + 2).alias("_name")
    ).where(F.length("_name") > 0)
    # One row: the lengths that names have, at most as many as an identifier may have characters.
    sizes = index.agg(
        F.collect_set(F.length("_name")), F.max(F.length("_schema")), F.max(F.size(F.split("_name", r"\."))), F.sum(F.octet_length("view_name"))
    ).first()
    if not sizes[0]:
        return queries.select("query_id", F.lit(None).cast("string").alias("view_name"), *carry).limit(0)
    lengths, longest, parts = F.array(*[F.lit(n) for n in sorted(sizes[0])]), sizes[1], sizes[2]
    texts = queries.select("query_id", *carry, F.lower("query_text").alias("_text"))
    variants = texts.select("query_id", *carry, F.explode(F.array_distinct(F.array("_text", _unquoted(F.col("_text"))))).alias("_text"))
    words = F.split("_text", r"\.")
    around = F.arrays_zip(*[F.slice(words, i + 1, F.size(words) - (1 if i else 0)).alias(f"p{i}") for i in range(parts + 1)])
    dots = variants.select("query_id", *carry, F.explode(around).alias("_p")).where(F.col("_p.p1").isNotNull())
    beside = dots.select(
        "query_id", *carry, F.right("_p.p0", F.lit(longest)).alias("_before"), F.concat_ws(".", *[f"_p.p{i + 1}" for i in range(parts)]).alias("_after")
    )
    held = beside.withColumn("_n", F.explode(lengths)).where(F.col("_n") <= F.length("_after"))
    index = index.hint("broadcast" if sizes[3] <= SENT_NAMES else "merge")
    hits = held.select("query_id", *carry, "_before", F.left("_after", "_n").alias("_name")).join(index, "_name").filter(F.endswith("_before", "_schema"))
    return hits.select("query_id", "view_name", *carry).distinct()


# Bits of one word of a table set.
_WORD = 64


def _table_sets(df: DataFrame, owner: str, numbered: DataFrame) -> DataFrame:
    """Per owner its set of tables, as a map from a word's number to its bits."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_n") % _WORD).cast("int"))
    words = df.join(numbered, "table_name").groupBy(owner, F.floor(F.col("_n") / _WORD).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    return words.groupBy(owner).agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_set"))


def query_view_attribution(
    queries: DataFrame,
    scans: DataFrame,
    view_tables: DataFrame,
    as_of: dt.date | Column,
    days: int = MATERIALIZATION_LOOKBACK_DAYS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Which query used which view: its text names the view, and it scanned every table below it.

    Relational division by bit sets: the tables below views are numbered, a query's scans and a view's tables become words
    of 64 bits, and a query covers a view if no bit of the view is missing. Tables below no view are left out.

    ``queries``: ``query_id, query_text, started_at`` and the columns to ``carry`` along; ``scans``: ``query_id,
    table_name``, one row per scanned table; ``view_tables``: ``view_name, table_name``.
    """
    recent = queries.filter(_recent("started_at", as_of, days))
    below = view_tables.select("view_name", "table_name").distinct()
    numbered = rank_first(below.select("table_name").distinct(), "table_name", "table_name", "_n")
    needed = materialise(_table_sets(below, "view_name", numbered), "view-tables").withColumnRenamed("_set", "_needed")
    matched = join_text_match(recent, needed, carry)
    scanned = _table_sets(scans.select("query_id", "table_name"), "query_id", numbered)
    both = matched.join(needed, "view_name").join(scanned, "query_id")
    none = F.lit(0).cast("bigint")
    covers = F.forall(F.map_entries("_needed"), lambda e: F.coalesce(F.col("_set")[e["key"]], none).bitwiseAND(e["value"]) == e["value"])
    return both.filter(covers).select("query_id", "view_name", *carry)


def rescanned_gb(attribution: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """Queries and gigabytes read per view. The attribution carries ``scanned_bytes``, or ``queries`` adds them
    by ``query_id``."""
    if queries is not None:
        attribution = attribution.join(queries.select("query_id", "scanned_bytes"), "query_id")
    return attribution.groupBy("view_name").agg(
        F.count(F.lit(1)).alias("query_count"),
        (F.sum("scanned_bytes") / F.lit(2**30)).alias("total_gb_rescanned"),
    )


def dml_pattern_daily(log: DataFrame, as_of: dt.date | Column, days: int = INCREMENTAL_LOOKBACK_DAYS) -> DataFrame:
    """Load statements per table, day and kind; ``log``: ``table_name, started_at, statement_type``."""
    return (
        log.filter(_recent("started_at", as_of, days))
        .groupBy("table_name", F.col("started_at").cast("date").alias("day"), F.upper("statement_type").alias("statement_type"))
        .agg(F.count(F.lit(1)).alias("statements"))
    )


def append_mostly(daily: DataFrame) -> DataFrame:
    """Whether all of a table's load statements only add rows."""
    adds = F.col("statement_type").isin(*APPEND_STATEMENTS)
    return daily.groupBy("table_name").agg(F.bool_and(adds).alias("is_append_mostly"))


def incremental_tier(stats: DataFrame) -> DataFrame:
    """Suggested load strategy per table.

    ``stats``: ``table_name, size_mb, row_count, is_append_mostly, event_time_column, unique_column,
    sort_key_is_date``. Combinations no rule covers come out as ``unclassified``.
    """
    size, appends = F.col("size_mb"), F.coalesce(F.col("is_append_mostly"), F.lit(False))
    has_time, has_unique = F.col("event_time_column").isNotNull(), F.col("unique_column").isNotNull()
    date_sorted = F.coalesce(F.col("sort_key_is_date"), F.lit(False))
    rules = (
        (size < MIN_TABLE_MB, 0, "table"),
        (appends & has_time & (F.col("row_count") > MICROBATCH_MIN_ROWS), 1, "microbatch"),
        (appends & ~has_time & (size > MIN_TABLE_MB), 2, "append"),
        (~appends & size.between(MIN_TABLE_MB, MERGE_MAX_MB) & has_unique & ~date_sorted, 3, "merge"),
        (~appends & (size > MERGE_MAX_MB) & ~has_unique, 4, "delete+insert"),
    )
    tier, strategy = F.lit(None).cast("int"), F.lit("unclassified")
    for condition, number, label in reversed(rules):
        hit = F.coalesce(condition, F.lit(False))
        tier = F.when(hit, F.lit(number)).otherwise(tier)
        strategy = F.when(hit, F.lit(label)).otherwise(strategy)
    key = F.when(strategy == "merge", F.col("unique_column"))
    return stats.select("table_name", tier.alias("tier"), strategy.alias("strategy"), key.alias("unique_key"))
