"""Publication features, run analytics and monitoring as plain Spark jobs.

Every operator is a function from DataFrame (or Column) to DataFrame (or
Column); Catalyst plans the work and nothing here holds data in Python.
"""

__version__ = "0.1.0"
