"""Operators: functions from DataFrame to DataFrame with column names as arguments."""
