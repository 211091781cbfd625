"""tilewright: tile, feature and corpus analytics expressed as Spark DataFrames."""
