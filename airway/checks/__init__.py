"""Registered queries over the supplied tables."""


def load_checks():
    from airway.checks import joins, jobs, rows, scalars, tables  # noqa: F401
    from airway.checks.registry import CHECKS

    return CHECKS
