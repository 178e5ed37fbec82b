"""Structured Streaming jobs over the order topic.

Jobs write each micro-batch as its own partition of the target tables, replaced as a
whole when Spark runs the micro-batch again.  New rows are found by an anti join with
all other batches, so no unbounded state is kept and late events are never dropped.
"""
