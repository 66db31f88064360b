"""Registered queries: every operator over the driver's tables, with the SQL that checks it."""
