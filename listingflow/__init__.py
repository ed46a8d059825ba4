"""Property-listing data on Spark: payloads in, one current listings table out."""
