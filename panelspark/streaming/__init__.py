"""panelspark.streaming -- intentionally empty.

The reference computes on complete files only: it has no watermark, window,
state or late-data handling, so there is no streaming operator to rebuild.
Every panel operator is a plain DataFrame function; Structured Streaming users
can apply them per micro-batch (``foreachBatch``) without extra code here.
"""
