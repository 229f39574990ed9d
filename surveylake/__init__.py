"""surveylake: a PySpark toolkit for survey data lakes.

Sheet exports and XML documents land as all-text RAW tables, are cast by
declarative schema documents into typed PROCESSED tables with append-only
history and month-level replacement, and are published into one common
survey data model.  Every step is a DataFrame plan; no Python UDF is used.
"""

__version__ = "0.1.0"
