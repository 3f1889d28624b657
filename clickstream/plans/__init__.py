from clickstream.plans.catalog import QUERIES
from clickstream.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL"]
