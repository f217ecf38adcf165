"""The scalar helpers as SQL functions of a session, for users who write SQL.

The bodies are SQL, so the optimizer inlines them: no function call remains in a plan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# name: (parameters, type, body)
FUNCTIONS = {
    "cents_to_dollars": ("cents DECIMAL(18,2)", "DECIMAL(16,2)", "CAST(CAST(cents AS DECIMAL(18,0)) / 100 AS DECIMAL(16,2))"),
    "cents_to_dollars_pre_cast": ("cents DECIMAL(18,2)", "DECIMAL(20,6)", "CAST(cents AS DECIMAL(16,2)) / 100"),
    "cents_to_dollars_rounded": ("cents DECIMAL(18,2)", "DECIMAL(32,2)", "round(CAST(cents / 100 AS DECIMAL(38,9)), 2)"),
    "cents_to_dollars_cast": ("cents DECIMAL(18,2)", "DECIMAL(16,2)", "CAST(cents / 100 AS DECIMAL(16,2))"),
    "mask_column": ("value STRING, is_member BOOLEAN", "STRING", "CASE WHEN is_member THEN value ELSE 'REDACTED' END"),
    "safe_ratio": ("numerator DECIMAL(38,6), denominator DECIMAL(38,6)", "DECIMAL(38,6)", "try_divide(numerator, denominator)"),
    "flag_equals": ("value STRING, other STRING", "BOOLEAN", "coalesce(value = other, false)"),
    "date_shift_days": ("day DATE, n INT", "DATE", "date_add(day, n)"),
    "date_shift_months": ("day DATE, n INT", "DATE", "add_months(day, n)"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Makes the functions known to this session; a second call replaces them."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(FUNCTIONS)
