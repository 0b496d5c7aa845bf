"""Operators for preparing training text: one module per operator, queries in ``queries``.

Nothing outside this folder imports it. Every operator takes and returns DataFrames; work on
whole texts happens in tasks (built-in functions, or numpy on Arrow batches), and everything that
relates rows to each other is a join or an aggregation.
"""
