"""Training-data operators: deduplication, search, quality, licences,
packing, mixing and URL filters, each a function from DataFrames to a
DataFrame. Nothing outside this package imports it."""
