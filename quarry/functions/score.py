"""Relevance: BM25 (Robertson & Zaragoza 2009) as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

K1, B = 1.2, 0.75


def idf(n_elements: Column, df: Column) -> Column:
    return F.log(1 + (n_elements - df + 0.5) / (df + 0.5))


def tf_norm(tf: Column, length: Column, avg_length: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / avg_length))


def edit_boost(distance: Column, token: Column, term: Column) -> Column:
    """Weight of a fuzzy match: one minus edits per character of the shorter word."""
    return 1 - distance / F.least(F.length(token), F.length(term))
