"""portrait: user-profile analytics as Spark DataFrame jobs.

Every public function takes and returns DataFrames (or Columns) and stays
inside Spark SQL, so Catalyst can prune, push down, and pick join strategies.
"""

__version__ = "0.1.0"
