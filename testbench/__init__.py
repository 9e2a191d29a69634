"""The operators as queries over the test tables, and the same in SQL; not part of the package."""
