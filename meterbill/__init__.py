"""meterbill: usage mediation, rating, billing and revenue analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from native
Spark expressions, so Catalyst can prune, push down and codegen the whole
plan. Dates are explicit ``as_of`` arguments; nothing reads the wall clock
except ``generated_at`` stamps.
"""

from meterbill.session import checkpoint_root, get_spark

__all__ = ["get_spark", "checkpoint_root"]
