"""waybatch: delivery batching and routing on Spark DataFrames.

Trip records become clean deliveries (zone lookup, bounding box, year
shift), CSV inputs are checked with a quality report, deliveries are cut
into ordered fixed-size batches with a distributed sequence, each batch is
routed (input order or greedy nearest neighbour), and routes are appended
to a table with WKT geometry and a continued surrogate key.
"""

__version__ = "0.1.0"
