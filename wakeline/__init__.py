"""wakeline: behaviour features and distribution-drift monitoring on Spark.

Every public operator is a function ``DataFrame -> DataFrame`` built from the
DataFrame API, so Catalyst sees the whole plan (pushdown, pruning, partial
aggregation) and Tungsten runs it inside whole-stage codegen.
"""

__version__ = "0.1.0"
