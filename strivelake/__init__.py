"""strivelake: a Spark-native change-data and benefits-KPI pipeline.

Every step is a function from DataFrame to DataFrame built on built-in Spark
expressions, joins, windows and Structured Streaming sinks.
"""

__version__ = "0.1.0"
