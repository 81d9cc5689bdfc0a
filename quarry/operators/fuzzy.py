"""Fuzzy expansion of search tokens over the vocabulary, as an equi-join on signatures.

Two words within k edits share a word reached by deleting at most k letters from
each. Long words use substrings instead: five segments of the vocabulary word, of
which two edits leave at least one intact and at most two places away. Both schemes
are chosen by the length of the vocabulary word, so no pair is missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import auto_edits, edit_distance_upto_two
from quarry.scale import lookup_join, pushed_values, settle

FIELD = ["entity_type_id", "property_id"]
LONG = 16
SEGMENTS = 5


def _none() -> Column:
    return F.array().cast("array<string>")


def _one_deleted(w: str) -> Column:
    return F.expr(
        f"transform(sequence(1, length({w})), i -> concat(substr({w},1,i-1), substr({w},i+1)))"
    )


def _two_deleted(w: str) -> Column:
    return F.expr(
        f"flatten(transform(sequence(1, length({w})-1), i -> transform(sequence(i+1, length({w})),"
        f" j -> concat(substr({w},1,i-1), substr({w},i+1,j-i-1), substr({w},j+1)))))"
    )


def _tag(level: str, words: Column) -> Column:
    return F.transform(words, lambda w: F.concat(F.lit(level), w))


def _deletions(w: str, exact: Column, one: Column, two: Column) -> Column:
    word = F.array(F.col(w))
    return F.concat(
        F.when(exact, _tag("0:", word)).otherwise(_none()),
        F.when(one, _tag("1:", F.concat(word, _one_deleted(w)))).otherwise(_none()),
        F.when(two, _tag("2:", F.concat(word, _one_deleted(w), _two_deleted(w)))).otherwise(_none()),
    )


def _hash(signature: Column) -> Column:
    """Half of a 64-bit hash: sorted and stored it takes a fraction of the room, and what meets by chance is
    sorted out by its edits."""
    return F.shiftright(F.xxhash64(signature), 32).cast("int")


def _patterns(n: int) -> list[tuple[str, int, int]]:
    """Level and the two places that are left out (past the end: none) of each signature of a word of ``n``
    letters; of a long one its segments."""
    if n > LONG:
        return [("3:", s, 0) for s in range(1, SEGMENTS + 1)]
    whole, one = [(n + 1, n + 2)], [(i, n + 1) for i in range(1, n + 1)]
    two = [(i, j) for i in range(1, n) for j in range(i + 1, n + 1)]
    levels = {"0:": whole if n <= 2 else [], "1:": whole + one if 2 <= n <= 6 else [], "2:": whole + one + two if n >= 4 else []}
    return [(level, i, j) for level, places in levels.items() for i, j in places]


_PATTERN = "array<struct<level:string,i:int,j:int>>"


def exploded_signatures(vocabulary: DataFrame, w: str = "term") -> DataFrame:
    """``vocabulary`` with ``sig``, a row per signature under which its word can be found.

    What is left out depends on the length alone, so a row per pattern comes from a constant, and
    letters are compared and hashed column by column, without a lambda per signature. Of patterns that
    leave the same word only one stays: that whose remaining letters are each the first possible ones.
    """
    known = ", ".join(
        "array(" + ", ".join(f"named_struct('level', '{level}', 'i', {i}, 'j', {j})" for level, i, j in _patterns(n)) + ")"
        for n in range(LONG + 2)
    )
    of_length = F.get(F.expr(f"array({known})"), F.least(F.length(w), F.lit(LONG + 1)))
    rows = vocabulary.select("*", F.explode(of_length.cast(_PATTERN)).alias("_p")).select("*", "_p.*")
    left = F.expr(
        f"length({w}) > {LONG} or case when j = i + 1 then j >= length({w}) or (substr({w},i,1) <> substr({w},j+1,1) and substr({w},j,1) <> substr({w},j+1,1))"
        f" else substr({w},i,1) <> substr({w},i+1,1) and (j >= length({w}) or substr({w},j,1) <> substr({w},j+1,1)) end"
    )
    segment = (
        f"concat_ws(':', '3', length({w}), i, substr({w}, 1 + (i-1)*length({w}) div {SEGMENTS},"
        f" i*length({w}) div {SEGMENTS} - (i-1)*length({w}) div {SEGMENTS}))"
    )
    word = F.expr(
        f"case when length({w}) > {LONG} then {segment}"
        f" else concat(level, substr({w},1,i-1), substr({w},i+1,j-i-1), substr({w},j+1)) end"
    )
    return rows.where(left).withColumn("sig", _hash(word)).drop("_p", "level", "i", "j")


def token_signatures(w: str = "token") -> Column:
    """Signatures a search token probes; edits allowed follow its length."""
    n = F.length(w)
    probes = F.expr(
        f"flatten(transform(sequence(greatest(length({w})-2, {LONG + 1}), length({w})+2), n ->"
        f" flatten(transform(sequence(1, {SEGMENTS}), s -> transform(filter(sequence(-2, 2), o ->"
        f" 1 + (s-1)*n div {SEGMENTS} + o >= 1 and s*n div {SEGMENTS} + o <= length({w})), o ->"
        f" concat_ws(':', '3', n, s, substr({w}, 1 + (s-1)*n div {SEGMENTS} + o,"
        f" s*n div {SEGMENTS} - (s-1)*n div {SEGMENTS})))))))"
    )
    short = _deletions(w, n <= 2, n.between(3, 5), n.between(6, LONG + 2))
    return F.array_distinct(F.transform(F.concat(short, F.when(n >= LONG - 1, probes).otherwise(_none())), _hash))


def signature_table(vocabulary: DataFrame) -> DataFrame:
    """entity_type_id, property_id, sig, term, df: under which signatures each term is found.

    Built once with the index and stored by signature, so a search reads what its tokens probe.
    """
    return exploded_signatures(vocabulary.select(*FIELD, "term", "df")).select(*FIELD, "sig", "term", "df")


def expand(tokens: DataFrame, signatures: DataFrame) -> DataFrame:
    """Vocabulary terms within the allowed edits of each token of the same field.

    ``tokens`` has entity_type_id, property_id, token; ``signatures`` is a ``signature_table``.
    Every such pair is returned, with df and distance.
    """
    wanted = tokens.select(*FIELD, "token").distinct()
    # A token has up to some 170 signatures, so the probes are measured themselves.
    probes, few = settle(wanted.select(*FIELD, "token", F.explode(token_signatures()).alias("sig")), "probes")
    pushed = pushed_values(probes, [*FIELD, "sig"]) if few else None
    asked = signatures if pushed is None else signatures.where(pushed)
    met = lookup_join(asked, probes, [*FIELD, "sig"], ["term"], small_fits=few)
    close = met.where(F.abs(F.length("token") - F.length("term")) <= auto_edits(F.col("token"))).select(*FIELD, "token", "term", "df").distinct()
    return close.withColumn("distance", edit_distance_upto_two("token", "term")).where(F.col("distance") <= auto_edits(F.col("token")))
