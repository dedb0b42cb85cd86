"""sparkloom: text and trip analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers for the driver tables, delimited trip text, one-document-per-line
           corpora, category links and cluster assignments; result writers
functions  Column builders: tokenisers, document-line parsing, trip cleaning predicates,
           hash uniforms, numerically stable losses
operators  the analytic operators: reports, vocabulary / TF-IDF, kNN, linear models,
           classifiers, the Gibbs topic model and evaluation
plans      the query registry run against the driver tables, with its DuckDB oracle SQL
"""

from sparkloom.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
