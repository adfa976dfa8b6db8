"""Transaction analytics as Spark DataFrame jobs: thinning, next-purchase
labels, cleaning, grouping, binning, hold-outs and purchase models."""
