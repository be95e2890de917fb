"""The llm queries and their SQL, for the entry point."""

from lectern.llm.queries import QUERIES
from lectern.llm.sql import ORACLE


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
