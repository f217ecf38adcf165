"""Data checks, contracts and versions.

A ``check_*`` function returns the failing rows, none meaning a pass. ``run_checks`` counts failures
for a whole list of checks with one scan per table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from martmill.operators.joins import anti_orphans


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their number of rows."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(F.col("n_records") > 1)


def check_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    return anti_orphans(child, column, parent, parent_column)


def check_accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Rows with another value; NULL passes."""
    return df.filter(~F.col(column).isin(list(values)))


def check_expression(df: DataFrame, expression: Column | str) -> DataFrame:
    """Rows on which the expression is false; NULL passes."""
    expression = F.expr(expression) if isinstance(expression, str) else expression
    return df.filter(~expression)


@dataclass(frozen=True)
class Check:
    """One declared check. ``argument`` is a value list, an expression, or (parent table, column)."""

    kind: str
    table: str
    column: str
    argument: object = None


def not_null_unique(table: str, column: str) -> list[Check]:
    return [Check("not_null", table, column), Check("unique", table, column)]


def _row_failure(check: Check) -> Column | None:
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    if check.kind == "accepted_values":
        return ~F.col(check.column).isin(list(check.argument))
    if check.kind == "expression":
        return ~F.expr(check.argument)
    return None


# The domain that counts rows failing a check of their own; key domains are numbered from 0.
_ROWS = -1


class _Domains:
    """Where every check finds its count.

    A key domain is a column that must be unique or that other columns point at; its own rows are side 0, and every
    column that points at it is one more side. Columns are named by frame, so tables that share one share their checks.
    """

    def __init__(self, tables: Mapping[str, DataFrame], checks: Sequence[Check]):
        self.frames = {id(df): df for df in tables.values()}
        self.sides: list[list[tuple[int, str]]] = []
        self.rows: list[Check] = []
        self.found_at: list[tuple[int, str, str]] = []  # per check: domain, key, name of the count
        self.owner = lambda table: id(tables[table])
        own: dict[tuple[int, str], int] = {}

        def domain(column: tuple[int, str]) -> int:
            if column not in own:
                own[column] = len(self.sides)
                self.sides.append([column])
            return own[column]

        wanted = []
        for check in checks:
            place = (self.owner(check.table), check.column)
            if check.kind == "unique":
                wanted.append((domain(place), "repeated"))
            elif check.kind == "relationships":
                parent, parent_column = check.argument
                at = domain((self.owner(parent), parent_column))
                if place not in self.sides[at][1:]:
                    self.sides[at].append(place)
                wanted.append((at, f"orphans{self.sides[at].index(place, 1)}"))
            elif _row_failure(check) is None:
                raise ValueError(f"unknown check {check.kind!r}")
            else:
                wanted.append(None)
        side_of = {column: (d, s) for d, listed in enumerate(self.sides) for s, column in enumerate(listed)}
        for check, found in zip(checks, wanted):
            place = (self.owner(check.table), check.column)
            if found is not None:
                self.found_at.append((found[0], "", found[1]))
            elif check.kind == "not_null" and place in side_of:
                self.found_at.append((side_of[place][0], "", f"nulls{side_of[place][1]}"))
            else:
                self.found_at.append((_ROWS, str(len(self.rows)), "rows"))
                self.rows.append(check)

    def tagged(self, frame: int) -> DataFrame | None:
        """(domain, value, side) for every key of a frame's rows and every check that a row fails."""
        df, entries = self.frames[frame], []

        def entry(domain: int, value: Column, side: int) -> Column:
            return F.struct(F.lit(domain).alias("domain"), value.cast("string").alias("value"), F.lit(side).alias("side"))

        for d, listed in enumerate(self.sides):
            parent, parent_column = listed[0]
            kind = self.frames[parent].schema[parent_column].dataType  # equal keys of two types have one text
            entries += [entry(d, F.col(column).cast(kind), s) for s, (owner, column) in enumerate(listed) if owner == frame]
        for n, check in enumerate(self.rows):
            if self.owner(check.table) == frame:
                entries.append(F.when(_row_failure(check), entry(_ROWS, F.lit(str(n)), 0)))
        if not entries:
            return None
        return df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select("e.*")


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row ``(check, table, column, failures)`` per check.

    Each frame is read once, whatever is checked about it. Its keys go, tagged with their domain and side, into one
    grouping by domain and value, summed before the shuffle: a key that is repeated, missing on one side or NULL shows
    in the counts of its sides. A hot key is one row per task by then.
    """
    if not checks:
        raise ValueError("no checks")
    domains = _Domains(tables, checks)
    parts = [t for t in map(domains.tagged, domains.frames) if t is not None]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    width = max([1, *map(len, domains.sides)])
    n = [F.col(f"n{i}") for i in range(width)]
    keys = union.groupBy("domain", "value").agg(*[F.count_if(F.col("side") == i).alias(f"n{i}") for i in range(width)])
    is_key = (F.col("domain") != _ROWS) & F.col("value").isNotNull()
    counts = {"rows": F.when(F.col("domain") == _ROWS, n[0]), "repeated": F.when(is_key & (n[0] > 1), 1)}
    for i in range(width):
        counts[f"nulls{i}"] = F.when(F.col("value").isNull(), n[i])
        counts[f"orphans{i}"] = F.when(is_key & (n[0] == 0), n[i])
    by_check = F.when(F.col("domain") == _ROWS, F.col("value")).otherwise("").alias("key")
    summed = keys.groupBy("domain", by_check).agg(*[F.sum(c).alias(name) for name, c in counts.items()])
    pairs = [x for name in counts for x in (F.lit(name), F.col(name))]
    found = summed.select("domain", "key", F.explode(F.create_map(*pairs)).alias("name", "failures"))
    listed = [
        F.struct(*[F.lit(v).alias(k) for k, v in zip(("check", "table", "column", "domain", "key", "name"), (c.kind, c.table, c.column, *at))])
        for c, at in zip(checks, domains.found_at)
    ]
    rows = union.sparkSession.range(1).select(F.explode(F.array(*listed)).alias("c")).select("c.*")
    joined = rows.join(found, ["domain", "key", "name"], "left")
    return joined.select("check", "table", "column", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    not_null: bool = True


def enforce_contract(df: DataFrame, columns: Sequence[ContractColumn]) -> DataFrame:
    """Exactly the contracted columns, in order, cast to their types.

    Missing or surplus columns fail at once. A NULL in a not-null column fails the job that writes
    the table, in the same pass that writes it: no extra count over the data.
    """
    names = [c.name for c in columns]
    if set(names) != set(df.columns):
        missing, surplus = set(names) - set(df.columns), set(df.columns) - set(names)
        raise ValueError(f"contract: missing {sorted(missing)}, not contracted {sorted(surplus)}")
    out = []
    for c in columns:
        value = F.col(c.name).cast(c.type)
        if c.not_null:
            broken = F.raise_error(F.lit(f"contract: NULL in {c.name}")).cast(c.type)
            value = F.coalesce(value, broken)
        out.append(value.alias(c.name))
    return df.select(*out)


def contract_schema(columns: Sequence[ContractColumn]) -> StructType:
    return StructType([StructField(c.name, DataType.fromDDL(c.type), not c.not_null) for c in columns])


def project_version(df: DataFrame, exclude: Sequence[str] = (), rename: Mapping[str, str] | None = None) -> DataFrame:
    """Another version of a table: some columns renamed, some left out."""
    for old, new in (rename or {}).items():
        df = df.withColumnRenamed(old, new)
    return df.drop(*exclude)


def compare_expected(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """The rows that differ between two frames of the same columns, in any order: each with the ``side`` that has more
    of it and how many ``times`` more. Nulls are equal. Both sides are read once and counted before they are shuffled."""
    columns = actual.columns
    if sorted(columns) != sorted(expected.columns):
        raise ValueError(f"columns differ: {columns} and {expected.columns}")
    both = actual.withColumn("_n", F.lit(1)).unionByName(expected.withColumn("_n", F.lit(-1)))
    counted = both.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    side = F.when(F.col("_n") > 0, "actual").otherwise("expected")
    return counted.withColumns({"side": side, "times": F.abs("_n")}).drop("_n")
