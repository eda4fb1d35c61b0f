"""dossier — Spark-native operators for party, case and transaction analytics.

Every operator is a pure function ``DataFrame(s) -> DataFrame`` built on
Spark's built-in functions, so Catalyst plans it and it runs distributed.
"""

__version__ = "0.1.0"
