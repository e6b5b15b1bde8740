"""Operators of a training-data pipeline, one module each.

Nothing outside this subpackage imports it. ``queries`` registers the ``opN_``
queries; the pipeline over them is ``corpus_pipeline`` at the repository top.
"""
