"""churnlake: customer-retention analytics as Spark DataFrame transformations."""

from churnlake.spec import TELCO, ChurnSpec

__all__ = ["TELCO", "ChurnSpec"]
