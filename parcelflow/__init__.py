"""Order and inventory flows on Spark: decode, split, aggregate, merge, stream."""
