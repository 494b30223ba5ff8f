"""Operators of a training-data pipeline; each module's docstring gives its defined results."""
