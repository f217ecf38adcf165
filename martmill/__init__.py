"""martmill: marts, incremental loads, metrics and table checks as Spark DataFrame code."""
