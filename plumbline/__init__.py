"""Profiling, preparation and regression modelling of tables on Spark."""
