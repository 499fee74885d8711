"""Every operator as a named query over the test tables, with SQL to check it by."""
