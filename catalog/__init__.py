"""Registered queries and their SQL counterparts, by the layer they exercise.

Bounds, caps and cut points come from the data itself, so the queries cover whole
tables and mean the same at every scale.
"""
