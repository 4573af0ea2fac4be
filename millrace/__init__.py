"""millrace: a Spark-native change-data engine.

Scans and change streams become DataFrames; mappings compile once to Catalyst expressions; versioned
documents collapse to a latest-version view.
"""

__version__ = "0.1.0"
