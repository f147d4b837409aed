"""Spark-native operators for labeled sensor time series.

Every operator takes and returns a ``DataFrame``; entity, order, label and
measurement columns are parameters.  Layout:

* ``sources``   — typed readers (CSV with a trailing ``;``, partitioned Parquet,
  file streams, Kafka options, fitted models).
* ``sinks``     — partitioned / appended Parquet, per-batch CSV, metrics table.
* ``functions`` — column expressions (clipping, missing-value tests, JSON).
* ``operators`` — relational and window operators (cleaning, profiling, match
  audits, sampling, event runs, smoothing, lags, stride, class weights,
  evaluation).
* ``plans``     — ML stages and the model builder/fit/score plans, plus the
  registered queries used by ``__spark_entry__``.
* ``streaming`` — publish / decode / micro-batch scoring jobs.
"""

__version__ = "0.1.0"
