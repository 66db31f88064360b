"""Operators: plain functions from DataFrames to DataFrames (fits return small driver values)."""
