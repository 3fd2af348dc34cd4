"""Operators of a training-data pipeline. Nothing outside this folder (but the entry module and the pipeline) imports it."""
