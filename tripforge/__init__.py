"""Trip-record analytics and trip-duration modelling as Spark DataFrame jobs."""

__version__ = "0.1.0"
