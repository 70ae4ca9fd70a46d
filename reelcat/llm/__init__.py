"""Training-data operators: formatting, filtering, deduplication, mixing and tokenising as Spark jobs.

Nothing outside this folder (but ``corpus_pipeline.py`` and the guarded entry) imports it.
"""
