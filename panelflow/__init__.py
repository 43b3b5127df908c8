"""panelflow: entity-by-month indicator panels and web-text features on Spark.

The package is a set of plain DataFrame operators.  Nothing here holds state or a
session; every operator takes DataFrames and returns DataFrames (or, where a fit is
involved, a Spark ML model).
"""

__version__ = "0.1.0"
