"""hourcast: hourly ensemble weather drivers, built as Spark jobs.

Coarse (3- and 6-hourly) ensemble forecasts for many sites become clean,
hourly, unit-converted tables with standard variable names. Every step is a
DataFrame plan (joins, windows, column functions); nothing is collected to
the driver.
"""

from hourcast.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
