"""Weather-hazard analytics on Spark DataFrames.

Every operator takes DataFrames (and small parameter objects) and returns a
lazy DataFrame, so Catalyst plans a whole run as one query.
"""

__version__ = "0.1.0"
