"""lakeloom: a layered commerce lakehouse toolkit written as plain PySpark."""

from lakeloom.session import tune, workspace

__all__ = ["tune", "workspace"]
