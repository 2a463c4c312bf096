"""DataFrame-level operators: filters, reshaping, segmentation, deduplication, joins, profiling, features."""
