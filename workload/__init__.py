"""Queries over the provided tables, each with its check SQL."""


def all_queries():
    """(queries, check SQL) by name; the modules register on import."""
    from workload import q_audit, q_clean, q_io, q_master, q_notices, q_pages, q_scalar  # noqa: F401
    from workload.oracle import sql
    from workload.registry import CHECKS, QUERIES
    return dict(QUERIES), {name: sql(check) for name, check in CHECKS.items()}
