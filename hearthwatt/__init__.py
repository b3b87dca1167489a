"""Household energy analytics and forecasting on Spark DataFrames.

Sub-packages:

* ``sources``   - typed readers, writers, schema report and row preview
* ``functions`` - column expressions (parsing, calendar, keyed hashing, numeric)
* ``operators`` - DataFrame-to-DataFrame operators and model fitting
* ``plans``     - the two end-to-end jobs and the query catalogue

Functions take the caller's DataFrames (and through them the caller's session)
and never change session configuration.
"""
