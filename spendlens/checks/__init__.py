"""Every operator as a named query over the test tables, with the same query in SQL."""
