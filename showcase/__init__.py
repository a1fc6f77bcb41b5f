"""Every operator exercised on the given tables, with an SQL equivalent."""
