"""Operators for preparing large text, page and vector corpora.

Nothing outside this package imports it; the entry module adds its queries only
where the package is present.
"""
