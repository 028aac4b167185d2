"""Operators for preparing large language-model training corpora.

Each module holds one operator as a DataFrame -> DataFrame function; ``queries``
applies them to the driver's tables and ``oracle`` holds the DuckDB SQL for those
that SQL can express. Nothing outside this folder (and ``corpus_pipeline``)
imports it.
"""
