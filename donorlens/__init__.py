"""donorlens: donor and customer analytics (RFM, cohorts, LTV, retention, churn) on Spark.

Entry points: ``plans.marts.MartPlan`` (the 18 marts as lazy DataFrames), ``plans.pipeline.run_pipeline``
(ingest + refresh), ``streaming.landing.start_ingest`` (incremental loads), ``python -m donorlens``.
"""

__version__ = "0.1.0"
