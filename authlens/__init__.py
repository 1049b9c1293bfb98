"""Authority-data analytics on Spark: snapshots, links, retrieval, merging, queues and evaluation."""
