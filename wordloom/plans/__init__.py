"""The registered queries and the SQL each is checked against."""

from wordloom.plans.checks import check_sql
from wordloom.plans.queries import registered

__all__ = ["check_sql", "registered"]
