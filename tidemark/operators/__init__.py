"""The data operators: plain functions from DataFrames to DataFrames."""
