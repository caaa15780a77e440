"""Queries over the test tables, each beside the SQL that must give the same rows."""

from doccairn.catalog import registry  # noqa: F401
