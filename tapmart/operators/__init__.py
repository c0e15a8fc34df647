"""DataFrame operators. All are lazy, except where a docstring says that a table is written."""
