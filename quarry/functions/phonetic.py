"""Metaphone codes (published rules of Lawrence Philips, 1990) as column functions.

Spark has ``soundex`` but no ``metaphone``. A letter's sound depends on the original letters
around it only, so every position is decided by itself and the sounds are joined. The caller
codes each distinct vocabulary term once. Null stays null; a term without A-Z has an empty code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_CODE = 4
_VOWELS, _FRONT = list("AEIOU"), list("EIY")


def _started(text: Column) -> Column:
    """Word starts that are rewritten first."""
    return (
        F.when(F.substring(text, 1, 2).isin("KN", "GN", "PN", "WR"), F.substr(text, F.lit(2)))
        .when(text.startswith("AE"), F.substr(text, F.lit(2)))
        .when(text.startswith("X"), F.concat(F.lit("S"), F.substr(text, F.lit(2))))
        .when(text.startswith("WH"), F.concat(F.lit("W"), F.substr(text, F.lit(3))))
        .otherwise(text)
    )


def _sound(padded: Column, at: Column) -> Column:
    """The sound of the letter at ``at``; ``padded`` has two blanks before the word and after it."""
    def letter(offset: int) -> Column:
        return F.substr(padded, at + offset, F.lit(1))

    def pair() -> Column:
        return F.substr(padded, at + 1, F.lit(2))

    own, before, after, second = letter(0), letter(-1), letter(1), letter(2)
    vowel, front, h = after.isin(_VOWELS), after.isin(_FRONT), after == "H"
    h_consonant = h & ~second.isin(_VOWELS) & (second != " ")
    silent = F.lit("")
    c = (
        F.when((before == "S") & front, silent)
        .when(pair() == "IA", "X")
        .when(front, "S")
        .when((before == "S") & h, "K")
        .when((before == " ") & h_consonant, "K")
        .when(h, "X")
        .otherwise("K")
    )
    g = (
        F.when((before == "D") & (letter(-2) != "D") & front, silent)  # DGE, DGI, DGY: told by the D
        .when(h & (second == " "), silent)
        .when(h_consonant, silent)
        .when((before != " ") & F.rtrim(F.substr(padded, at + 1)).isin("N", "NED"), silent)
        .when(front, "J")
        .otherwise("K")
    )
    t = F.when(pair().isin("IA", "IO"), "X").when(pair() == "CH", silent).when(h, "0").otherwise("T")
    return (
        F.when((own == before) & (own != "C"), silent)
        .when(own.isin(_VOWELS), F.when(before == " ", own).otherwise(silent))
        .when(own.isin(list("FJLMNR")), own)
        .when(own == "B", F.when((before == "M") & (after == " "), silent).otherwise("B"))
        .when(own == "C", c)
        .when(own == "D", F.when((after == "G") & second.isin(_FRONT), "J").otherwise("T"))
        .when(own == "G", g)
        .when(own == "H", F.when(vowel & ~before.isin(list("CGPST")), "H").otherwise(silent))
        .when(own == "K", F.when(before == "C", silent).otherwise("K"))
        .when(own == "P", F.when(h, "F").otherwise("P"))
        .when(own == "Q", "K")
        .when(own == "S", F.when(h | pair().isin("IO", "IA"), "X").otherwise("S"))
        .when(own == "T", t)
        .when(own == "V", "F")
        .when(own.isin("W", "Y"), F.when(vowel, own).otherwise(silent))
        .when(own == "X", "KS")
        .otherwise("S")  # Z
    )


def metaphone_code(term: str | Column, max_code: int = MAX_CODE) -> Column:
    """Code of one word of at most ``max_code`` symbols; characters outside A-Z carry no sound."""
    term = F.col(term) if isinstance(term, str) else term
    text = F.regexp_replace(F.upper(term), "[^A-Z]", "")
    padded = F.concat(F.lit("  "), _started(text), F.lit("  "))

    def code(word: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(3), F.length(word) - 2), lambda at: _sound(word, at)), "")

    # As a lambda variable the padded word is evaluated once, not once per look at a letter.
    coded = F.element_at(F.transform(F.array(padded), code), 1)
    return F.when(F.length(text) < 2, text).otherwise(F.substring(coded, 1, max_code))
