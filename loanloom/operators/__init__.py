"""Operators on loan and lease tapes: functions from DataFrames to DataFrames."""
