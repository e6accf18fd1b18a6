"""portrait — real-time e-commerce user profiling on Spark.

Change records and app page logs go in; per-user device/search profiles,
order x user x dimension wide rows and a predicted age band per row come
out.  Every operator is a DataFrame -> DataFrame function so the same code
runs in batch (``spark.read``) and in Structured Streaming
(``spark.readStream``).
"""

__version__ = "0.1.0"
