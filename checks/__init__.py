from checks.oracles import oracle_sql
from checks.queries import queries

__all__ = ["oracle_sql", "queries"]
