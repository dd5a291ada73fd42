"""Operators: functions from DataFrames to a DataFrame; lazy, without collects or Python UDFs."""
