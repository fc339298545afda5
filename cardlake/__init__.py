"""cardlake: retail banking and card analytics as composable Spark DataFrame functions.

Layers: raw files -> bronze -> silver -> gold -> serving views -> report queries.
Every stage is a pure ``DataFrame -> DataFrame`` function built from Spark's
built-in expressions, so Catalyst sees one declarative plan per action.
"""

__all__ = ["functions", "sources", "operators", "plans"]
