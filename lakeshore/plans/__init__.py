"""Plans: the SQL query set, the query runner/benchmark loop, pipelines and the registry."""

from pathlib import Path

SQL_DIR = Path(__file__).with_name("sql")
SMOKE_SQL_DIR = Path(__file__).with_name("smoke")
