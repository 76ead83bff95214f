"""sevlab — Spark-native preparation, profiling and severity modelling of coded event tables.

Every operator is a function ``DataFrame -> DataFrame`` (or ``DataFrame -> small fitted
numbers``) that takes its column names as parameters and runs on built-in Spark operators.

Layout:
  sources/    CSV / parquet / model readers and writers
  functions/  column expressions (sentinels, date/hour parsing, bins, flags, hashing)
  operators/  cleaning, imputation, statistics, outliers, balance, sampling, features, model
  plans/      end-to-end jobs (integrate, prepare, profile, correlate, train, score),
              the binding to the test tables and the registered queries
  streaming/  the fitted, stateless preparation applied to a Structured Streaming source
"""

__version__ = "0.1.0"
