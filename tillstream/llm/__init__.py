"""Operators of a training-data pipeline: text, tokens, archives, duplicates, shards.

Nothing else in the library imports this package.  Work inside tasks is done on Arrow
batches with numpy; Spark partitions, shuffles, joins and groups.
"""
