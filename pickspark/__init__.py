"""Analytics over phase-pick catalogs as Spark jobs: plain functions from DataFrames to DataFrames."""
