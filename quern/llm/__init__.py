"""Operators of a training-data pipeline, each a Spark job on the ``documents``
or ``pages`` table.  Nothing outside this folder (and ``corpus_pipeline.py``)
imports it; ``queries`` binds the operators to the driver's tables."""
