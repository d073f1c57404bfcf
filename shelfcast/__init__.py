"""shelfcast: store-level demand forecasting expressed as Spark DataFrame jobs.

Layout
------
sources/    schemas, readers, adapter views over the benchmark tables, sinks
functions/  Column-expression helpers (text, calendar, metrics, statistics)
operators/  DataFrame -> DataFrame operators (cleaning, features, quality,
            series, forecasting, evaluation, ML)
plans/      end-to-end jobs composed from operators (feature pipeline,
            backtests, submission) and the query registry
"""

__version__ = "0.1.0"
