"""Forecasting over many sensor streams with DataFrames and Structured Streaming."""
