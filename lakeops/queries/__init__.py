"""Every operator as a named query over the given tables, next to the SQL that checks it."""
