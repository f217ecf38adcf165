"""The models: staging, intermediate tables and marts, as functions over DataFrames."""
