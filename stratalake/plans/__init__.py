"""The models of the Silver, Gold and Platinum layers as lazy DataFrames."""
