"""Operators: per-cell statistics, outlier rules, reductions, reports."""
