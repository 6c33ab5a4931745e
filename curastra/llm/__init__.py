"""Operators of a training-data pipeline: deduplication, quality, tokens, search, licences, mixing, privacy, chat, language.

Nothing else in the package imports this subpackage; the entry module adds its queries only where it can be imported.
"""
