"""Batch analytics on Wi-Fi access-point readings and road-traffic traces.

Every operator takes DataFrames and returns a DataFrame; reading and writing live
in ``sources`` and ``plans``.
"""
