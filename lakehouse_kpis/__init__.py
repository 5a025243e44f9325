"""Sales-and-finance lakehouse analytics as lazy PySpark DataFrame transforms."""

from lakehouse_kpis.plans.lakehouse import Lakehouse

__all__ = ["Lakehouse"]
