"""Training-data operators: sharding, quality, licences, tokenizers, deduplication, extraction, selection.

Every operator is a function over DataFrames; the work runs in Spark tasks
(Arrow batches through numpy where built-in functions cannot express the
method). Nothing outside this subpackage imports it.
"""
