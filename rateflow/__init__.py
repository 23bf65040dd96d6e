"""rateflow: a rating-prediction feature engine written as Spark DataFrame plans.

Layout
------
- ``sources``   – line, JSON-lines and CSV readers, the prediction sink, and the
                  adapter that turns the parquet test tables into the job's inputs.
- ``functions`` – column expressions for the per-line features (no UDFs).
- ``operators`` – dimensions, aggregates, joins with mean defaults, standardiser.
- ``plans``     – feature matrix, boosted-tree model, evaluation, whole pipeline.
- ``llm``       – operators for training-data corpora; nothing else here imports it.
"""

__version__ = "0.1.0"
