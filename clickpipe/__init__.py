"""clickpipe: ad-click prediction pipelines expressed on Spark DataFrames and Spark ML.

Layout
  sources/    readers, writers, declared schemas, fixture views
  operators/  joins, projections, sampling and splitting
  functions/  reusable column expressions (hash buckets) and size checks
  plans/      feature pipeline, learners, tuning, evaluation, end-to-end jobs
  streaming/  applying a fitted pipeline to a streaming source
"""

__version__ = "0.1.0"
