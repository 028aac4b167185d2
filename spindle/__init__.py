"""spindle: a Spark-native language-model corpus toolkit.

Corpora are read as DataFrames, tokenised with a vocabulary learned by a Spark
aggregation, packed into fixed training blocks, fitted into a count-based n-gram
model, and completed with a chain of score processors. Every stage is a
DataFrame -> DataFrame function so stages compose with ``DataFrame.transform``.
"""

__version__ = "0.1.0"
