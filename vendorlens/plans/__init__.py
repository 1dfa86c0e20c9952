"""Plan assembly: size-checked joins, the session catalog of stored tables,
the query registry and the SQL oracle."""
