"""Text analysis as Column expressions: tokens, shingles, query clauses, edit distance."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

STANDARD, METAPHONE, NOT_ANALYZED = "STANDARD", "METAPHONE", "NOT_ANALYZED"

# Word tokens; inner apostrophes and dots stay (don't, 3.14, U.S.A).
WORD = r"[\p{L}\p{N}_]+(?:['’.][\p{L}\p{N}_]+)*"
LETTERS = r"\p{L}+"
# A query is made of quoted phrases, terms marked with ~, and runs of plain terms.
_PLAIN = r"(?![^\s\"]*~(?:[\s\"]|$))[^\s\"]+"
QUERY_ITEM = rf'"[^"]*"~?|[^\s"]+~(?=[\s"]|$)|{_PLAIN}(?:\s+{_PLAIN})*'


def standard_tokens(value: Column) -> Column:
    """Lowercased word tokens, in order."""
    return F.regexp_extract_all(F.lower(value), F.lit(WORD), F.lit(0))


def letter_tokens(value: Column) -> Column:
    """Lowercased runs of letters; digits separate like punctuation."""
    return F.regexp_extract_all(F.lower(value), F.lit(LETTERS), F.lit(0))


def keyword_token(value: Column) -> Column:
    """The whole value as one token, case kept."""
    return F.array(value)


def analyze(value: Column, analyzer: Column) -> Column:
    """Base tokens of a value under the analyzer its property declares."""
    return (
        F.when(analyzer == NOT_ANALYZED, keyword_token(value))
        .when(analyzer == METAPHONE, letter_tokens(value))
        .otherwise(standard_tokens(value))
    )


def positioned(tokens: Column) -> Column:
    """Tokens as ``array<struct<pos, term>>``."""
    return F.transform(
        tokens, lambda t, i: F.named_struct(F.lit("pos"), i, F.lit("term"), t)
    )


def shingles(tokens: Column) -> Column:
    """Two-token shingles joined without a separator, at the first token's position."""
    pairs = F.arrays_zip(
        F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))).alias("a"),
        F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))).alias("b"),
    )
    return F.transform(
        pairs,
        lambda p, i: F.named_struct(
            F.lit("pos"), i, F.lit("term"), F.concat(p.getField("a"), p.getField("b"))
        ),
    )


def fuzzy_rewrite(term: Column) -> Column:
    """Append ``~`` to each blank-separated term unless it ends in ``~`` or a quote.

    Trailing blanks vanish; inner double blanks leave a lone ``~``.
    """
    trimmed = F.regexp_replace(term, " +$", "")
    parts = F.split(trimmed, " ", -1)
    marked = F.transform(
        parts,
        lambda t: F.when(F.endswith(t, F.lit("~")) | F.endswith(t, F.lit('"')), t).otherwise(
            F.concat(t, F.lit("~"))
        ),
    )
    return F.when((trimmed == "") & (term != ""), "").otherwise(F.array_join(marked, " "))


def query_items(query: Column) -> Column:
    """Split query text into ``array<struct<item_no, kind, text>>``.

    ``kind`` is ``phrase`` (quoted), ``fuzzy`` (ends in ``~``) or ``plain``.
    """
    items = F.regexp_extract_all(query, F.lit(QUERY_ITEM), F.lit(0))

    def describe(item: Column, i: Column) -> Column:
        is_phrase = F.startswith(item, F.lit('"'))
        is_fuzzy = F.endswith(item, F.lit("~"))
        kind = F.when(is_phrase, "phrase").when(is_fuzzy, "fuzzy").otherwise("plain")
        text = F.when(is_phrase, F.regexp_replace(item, '^"|"~?$', "")).otherwise(
            F.regexp_replace(item, "~+$", "")
        )
        return F.named_struct(
            F.lit("item_no"), i, F.lit("kind"), kind, F.lit("text"), text
        )

    described = F.transform(items, describe)
    return F.filter(described, lambda s: F.length(s.getField("text")) > 0)


def auto_edits(token: Column) -> Column:
    """Edits allowed for a token: none below 3 characters, one up to 5, two beyond."""
    n = F.length(token)
    return F.when(n < 3, 0).when(n <= 5, 1).otherwise(2)


def _swap(i: str, o: str = "0") -> str:
    return (
        f"substr(x,{i},1) = substr(y,{i}+{o}+1,1) and substr(x,{i}+1,1) = substr(y,{i}+{o},1)"
    )


_ONE_EDIT = f"""(levenshtein(x, y, 1) >= 0
  or (length(x) = length(y) and length(x) > 1 and exists(sequence(1, length(x) - 1), i ->
        {_swap('i')} and substr(x,1,i-1) = substr(y,1,i-1) and substr(x,i+2) = substr(y,i+2))))"""

_TWO_EDITS = f"""(levenshtein(x, y, 2) >= 0
  or (levenshtein(x, y, 4) >= 0 and length(x) > 1 and exists(sequence(1, length(x) - 1), i ->
        exists(array(-1, 0, 1), o -> i + o >= 1 and i + o < length(y) and {_swap('i', 'o')}
          and levenshtein(substr(x,1,i-1), substr(y,1,i+o-1))
            + levenshtein(substr(x,i+2), substr(y,i+o+2)) <= 1)))
  or (length(x) = length(y) and length(x) > 3 and levenshtein(x, y, 4) >= 0
        and exists(sequence(1, length(x) - 3), i ->
          {_swap('i')} and substr(x,1,i-1) = substr(y,1,i-1)
          and exists(sequence(i + 2, length(x) - 1), j ->
            {_swap('j')} and substr(x,i+2,j-i-2) = substr(y,i+2,j-i-2)
            and substr(x,j+2) = substr(y,j+2)))))"""


def edit_distance_upto_two(x: str, y: str) -> Column:
    """Edit distance with adjacent transpositions (optimal string alignment), NULL above 2.

    ``x`` and ``y`` are column names. Built-in functions only: a transposition is
    recognised by its crossed pair of letters, the rest by ``levenshtein``.
    """
    sql = f"case when x = y then 0 when {_ONE_EDIT} then 1 when {_TWO_EDITS} then 2 end"
    # One-element transform binds the two column names to the short lambda variable names.
    return F.expr(
        f"transform(array(named_struct('x', {x}, 'y', {y})), p -> "
        + _bind(sql)
        + ")[0]"
    )


def _bind(sql: str) -> str:
    return re.sub(r"\b([xy])\b", r"p.\1", sql)
