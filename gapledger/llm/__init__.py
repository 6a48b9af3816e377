"""Operators of a training-data pipeline: formatting, language, quality,
toxicity, packing, decontamination, near duplicates, URL rules, LM scores.

Each module holds one operator with its own interface; ``queries`` binds the
operators to the test tables. Nothing outside this package imports it.
"""
