"""Column builders: rules, text and time helpers (all native expressions)."""

from . import constants, rules, text, timefmt  # noqa: F401
