"""Personal data in texts (operator 5): exact base patterns and a skip-chain random field.

Base spans are the leftmost non-overlapping matches of each kind's pattern that pass its test.
The field's nodes are all base spans, held at their kind, and every looser candidate (a run of
7 to 19 digits with usual separators, a name of up to 64 characters joined by @ or a written "at"
to a domain of parts of up to 63) that overlaps none of them, free to be any kind or nothing. Neighbouring nodes share a
transition potential; nodes that repeat the same digits or the same address, anywhere in the
document, share a skip potential that rewards equal labels. Loopy message passing over both
gives marginals; a free node whose likeliest label is a kind becomes an added span. All other
tokens can only be nothing and need no node.

Node weights are a softmax regression on the shape of a candidate (held small, so near misses
keep some chance), transitions and the strength of agreement are
counted; all on a bounded sample of documents labelled by the base patterns.

Repeats are linked to their previous occurrence, so links grow with the nodes, not with their
square. Spans are in code points, end exclusive.

Defined results: null and empty texts have no spans; rows that repeat get the same spans; an
empty table gives no rows; extra columns are carried along in ``row``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import carried, text_of

KINDS = ("email", "ip", "card", "phone")
NOTHING = len(KINDS)
TRAIN_ROWS = 2_000
ROUNDS = 25
DAMPING = 0.3
CERTAINTY = 0.75  # the marginal from which a free node's likeliest kind is a span

# --- base spans --------------------------------------------------------------------------
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins, which saves trying the rest of the run.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d)
        if i % 2:
            v = 2 * v - 9 * (v > 4)
        total += v
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Going out from every @ finds the leftmost matches without rescanning long runs."""
    spans, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        match = _DOMAIN.match(text, at + 1) if begin < at else None
        if match:
            spans.append((begin, match.end()))
            free = match.end()
        at = text.find("@", max(at + 1, free))
    return spans


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """The base spans of every kind, in the order of KINDS."""
    found: list[list[tuple[int, int]]] = [emails(text) if "@" in text else [], [], [], []]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                found[1].append(m.span())
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _digits(m[0])
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found[2].append(m.span())
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    found[3].append(m.span())
    return found


# --- nodes of the field ------------------------------------------------------------------
_NUMBER = re.compile(r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[ ().-]{0,2}[0-9]){6,}(?![0-9A-Za-z])")
_ADDRESS = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?)[A-Za-z0-9-]{1,63})+")
_AT = re.compile(r" ?(?:@|\(at\)|\[at\]) ?")
_DOT = re.compile(r"\.| ?\(dot\) ?| ?\[dot\] ?")
_FEATURES = 26


@dataclass
class Nodes:
    spans: list[tuple[int, int]]
    labels: np.ndarray  # the kind of a base span, NOTHING for a free node
    free: np.ndarray
    features: np.ndarray
    skips: np.ndarray  # pairs of nodes


def _shape(piece: str, address: bool) -> np.ndarray:
    x = np.zeros(_FEATURES)
    x[0] = 1
    if address:
        x[1] = 1
        x[2] = "." in piece
        return x
    x[3 + min(max(len(_digits(piece)), 7), 20) - 7] = 1  # 3 to 16
    x[17] = piece.count(".") == 3
    x[18] = "(" in piece
    x[19] = "-" in piece
    x[20] = " " in piece
    x[21] = len(re.split(r"[^0-9]+", piece.strip("+("))) == 1
    x[22] = 13 <= len(_digits(piece)) <= 19 and not luhn(_digits(piece))
    return x


def _keys(piece: str, address: bool) -> list[str]:
    """What repeated or similar nodes have in common."""
    if address:
        return ["@" + _DOT.sub(".", _AT.sub("@", piece)).lower()]
    digits = _digits(piece)
    return [digits, "~" + digits[-10:]] if len(digits) >= 10 else [digits]


def nodes(text: str, base: list[list[tuple[int, int]]]) -> Nodes | None:
    """The document's nodes in order, or None where no candidate is free."""
    taken = sorted((b, e, k) for k, spans in enumerate(base) for b, e in spans)
    starts = np.array([b for b, _, _ in taken], np.int64)
    reach = np.maximum.accumulate([e for _, e, _ in taken]) if taken else np.zeros(0, int)

    def clear(b: int, e: int) -> bool:
        at = int(np.searchsorted(starts, e))
        return at == 0 or reach[at - 1] <= b

    loose = []
    if "@" in text or "at)" in text or "at]" in text:
        loose += [(*m.span(), True) for m in _ADDRESS.finditer(text)]
    if _DIGIT.search(text):
        loose += [(*m.span(), False) for m in _NUMBER.finditer(text) if len(_digits(m[0])) <= 19]
    loose = [x for x in loose if clear(x[0], x[1])]
    if not loose:
        return None
    every = sorted([(b, e, k == 0, k) for b, e, k in taken] + [(b, e, a, NOTHING) for b, e, a in loose])
    last: dict[str, int] = {}
    skips = []
    for i, (b, e, address, _) in enumerate(every):
        for key in _keys(text[b:e], address):
            if key in last:
                skips.append((last[key], i))
            last[key] = i
    labels = np.array([k for *_, k in every])
    shapes = np.array([_shape(text[b:e], a) for b, e, a, _ in every])
    return Nodes([(b, e) for b, e, *_ in every], labels, labels == NOTHING, shapes, np.array(sorted(set(skips)), int).reshape(-1, 2))


# --- the field ---------------------------------------------------------------------------

@dataclass
class Field:
    unary: np.ndarray  # features by labels
    transition: np.ndarray  # log potentials of neighbours
    agreement: float  # log potential of equal labels of repeats


def marginals(field: Field, doc: Nodes, rounds: int = ROUNDS, damping: float = DAMPING) -> np.ndarray:
    """Sum-product message passing over chain and skip links; base nodes are held."""
    n, width = len(doc.labels), NOTHING + 1
    score = doc.features @ field.unary
    held = np.flatnonzero(~doc.free)
    score[held] = -50.0
    score[held, doc.labels[held]] = 0.0
    chain = np.stack([np.arange(n - 1), np.arange(1, n)], 1)
    same = np.eye(width) * field.agreement
    edges = np.concatenate([chain, doc.skips])
    forward = np.concatenate([np.repeat(field.transition[None], len(chain), 0), np.repeat(same[None], len(doc.skips), 0)])
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    potential = np.exp(np.concatenate([forward, forward.transpose(0, 2, 1)]))
    message = np.zeros((len(source), width))
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    for _ in range(rounds):
        belief = score.copy()
        np.add.at(belief, target, message)
        out = belief[source] - message[back]
        out -= out.max(axis=1, keepdims=True)
        new = np.log(np.einsum("es,est->et", np.exp(out), potential) + 1e-300)
        new -= new.max(axis=1, keepdims=True)
        moved = np.abs(new - message).max(initial=0)
        message = damping * message + (1 - damping) * new
        if moved < 1e-4:
            break
    belief = score.copy()
    np.add.at(belief, target, message)
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


def train(texts: list[str], steps: int = 300, rate: float = 1.0) -> Field:
    docs = []
    for text in texts:
        base = base_spans(text)
        found = nodes(text, base)
        if found is None and any(base):
            every = sorted((b, e, k) for k, spans in enumerate(base) for b, e in spans)
            shapes = np.array([_shape(text[b:e], k == 0) for b, e, k in every])
            labels = np.array([k for *_, k in every])
            found = Nodes([(b, e) for b, e, _ in every], labels, np.zeros(len(every), bool), shapes, np.zeros((0, 2), int))
        if found is not None:
            docs.append(found)
    width = NOTHING + 1
    weights, moves, agree, differ = np.zeros((_FEATURES, width)), np.ones((width, width)), 1.0, 1.0
    if docs:
        x = np.concatenate([d.features for d in docs])
        y = np.eye(width)[np.concatenate([d.labels for d in docs])]
        for step in range(steps):
            z = x @ weights
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            weights -= rate * (x.T @ (p - y) / len(x) + 1e-2 * weights)
        for d in docs:
            np.add.at(moves, (d.labels[:-1], d.labels[1:]), 1)
            known = d.skips[~d.free[d.skips].any(axis=1)] if len(d.skips) else d.skips
            equal = d.labels[known[:, 0]] == d.labels[known[:, 1]]
            agree, differ = agree + equal.sum(), differ + (~equal).sum()
    # Transitions relative to how often labels occur, so that they do not count the unaries twice.
    moves /= moves.sum()
    transition = np.log(moves / np.outer(moves.sum(1), moves.sum(0)))
    return Field(weights, np.clip(transition, -0.5, 0.5), float(np.clip(np.log(agree / differ), 3, 6)))


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS, id_column: str = "doc_id", text_column: str = "text") -> Field:
    """A field trained on at most ``train_rows`` documents, chosen by hash of their id."""
    order = F.xxhash64(F.col(id_column), F.lit("train"))
    ids = docs.filter(F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), order.alias("o")).orderBy("o", "id").limit(train_rows)
    chosen = docs.join(F.broadcast(ids.select("id").distinct()), F.col(id_column) == F.col("id"), "left_semi")
    rows = chosen.select(text_of(text_column).alias("t"), order.alias("o")).orderBy("o", "t").limit(train_rows).collect()
    return train([r.t for r in rows])


def find(text: str, field: Field) -> tuple[list[list[tuple[int, int]]], list[list[tuple[int, int]]]]:
    """Base spans and added spans by kind."""
    base = base_spans(text)
    added: list[list[tuple[int, int]]] = [[] for _ in KINDS]
    doc = nodes(text, base)
    if doc is not None:
        chances = marginals(field, doc)
        best = chances.argmax(axis=1)
        for i in np.flatnonzero(doc.free & (best != NOTHING) & (chances.max(axis=1) >= CERTAINTY)):
            added[best[i]].append(doc.spans[i])
    return base, added


def joined(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{b}:{e}" for kind, own in zip(KINDS, spans) for b, e in sorted(own))


def spans_of(docs: DataFrame, field: Field, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row as ``row`` with base and all spans joined, and counts of the base spans."""
    source = docs.select(carried(keep), text_of(text_column).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names = ["row", *[f"n_{k}" for k in KINDS], "n_added", "base", "spans"]

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in names[1:]]
            for text in batch.column(1).to_pylist():
                base, added = find(text, shared.value)
                values = [*map(len, base), sum(map(len, added)), joined(base), joined([b + a for b, a in zip(base, added)])]
                for column, value in zip(out, values):
                    column.append(value)
            types = [pa.int64()] * (len(KINDS) + 1) + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(out, types)]], names)

    counts = [F.lit(0).cast("long").alias(n) for n in names[1:-2]]
    schema = source.select("row", *counts, F.lit("").alias("base"), F.lit("").alias("spans")).schema
    return source.mapInArrow(run, schema)


