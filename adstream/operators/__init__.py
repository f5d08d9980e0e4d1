"""Operators on ad events, results, latencies and progress reports.

Each takes a DataFrame and returns one; those on events run on streams as well.
"""
