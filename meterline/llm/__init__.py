"""Training-data operators on Spark.

Thirteen operators, one module each (:mod:`.encode` is shared by two); :mod:`meterline.llm.queries` applies them to the given tables.  Nothing
outside this folder imports it (the top-level ``corpus_pipeline.py`` counts as part of it).
"""
