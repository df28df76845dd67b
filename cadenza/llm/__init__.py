"""Operators of a training-data pipeline; ``queries`` holds their registered queries."""
