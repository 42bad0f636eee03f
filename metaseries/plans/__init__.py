"""Registered queries and the SQL that checks them."""

from . import checks, records, series  # noqa: F401
