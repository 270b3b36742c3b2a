"""shoreline: table and stream operators for analytics jobs, written on the Spark DataFrame API.

Every operator takes DataFrames and returns a DataFrame, so Catalyst and AQE see one
declarative plan. The sub-packages follow the life of a table: ``sources`` read it,
``operators`` and ``functions`` shape it, ``sinks`` store it, ``streaming`` keeps it up to
date, ``ml`` learns from it and ``plans`` joins the steps into whole jobs.
"""
