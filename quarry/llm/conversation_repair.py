"""Repair of the turn structure of conversations (operator 12).

A conversation's rows, in order of their turn, must give role initials (s?(ua)+)?. Edits: Keep
(0), Rerole to user or assistant (3), Delete (4; the only choice for blank and repeated rows),
Insert an empty user or assistant turn anywhere (3). A row that ends within a sentence costs 3
unless deleted. Of the cheapest edit sequences the one with the ASCII-least audit (the edits'
initials) is taken.

Nodes are (row, state): nothing yet, after s, after u, after a. A pass from the last row back
gives every node's cost to go; arcs that keep it are optimal. Optimal nodes are ranked by the
audit letters of 1, 2, 4, ... steps: a rank of twice the length is the pair of a node's rank and
that of the node its pointer reaches, and pointers double with it. A letter leads from a node to
one node only, so each node has one pointer; its arc is the optimal one with the least letter
and then the least rank behind it. The path is read off through the doubled pointers. All
conversations of an Arrow batch are worked on at once.

A conversation of more than ``piece_rows`` rows is divided: rows get their place by a sort over
all partitions, pieces are reduced to a matrix of costs between states, the matrices (one small
row a piece) are chained per conversation, then pieces are repaired on their own and read once
in order for the hash. Rows seen earlier are found by a grouping there.

Defined results: a null role or text is one space, so such a text is blank and such a role
fits nowhere, like an empty one; only the first letters s, u and a fit. Rows of equal turn are in order
of role, then text; null turns come first. A null conversation id is a conversation. Ids without
rows left get zeros, an empty audit and the hash of the empty text; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import in_order, lookup, written
from quarry.scale import materialize

PIECE_ROWS = 8192
_WHITE = " \t\n\x0b\x0c\r"
_SOME = r"[^\x20\x09-\x0D]"
_LETTERS = "DIKR"  # in ASCII order; the codes of edits below
_DELETE, _INSERT, _KEEP, _REROLE = range(4)
_FINAL = np.array([0, 6, 3, 0])  # what is left to insert after the last row, by state
_NEXT = np.array([2, 2, 3, 2])  # where a user or assistant turn leads: the one that fits
_ROLE = {2: "user", 3: "assistant"}
# Where a kept row of initial s, u, a or any other leads, by state; -1: nowhere.
_KEPT = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_FAR = 1 << 40


# --- the rows ----------------------------------------------------------------------------

def group_key(column: str = "conv_id") -> Column:
    """The id as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def damaged(conversations: DataFrame) -> DataFrame:
    """key, turn, role, text after the damage that crc32(``conv_id:turn``) % 20 names."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select(group_key().alias("key"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    hurt = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", r"[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("kind <> 0").select(
        "key", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), hurt.alias("text"), F.explode(copies).alias("copy")
    ).drop("copy")


def _judged(rows: DataFrame) -> DataFrame:
    """With the row's initial as a code, whether it is blank and whether it ends within a sentence."""
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    last = F.substring(F.rtrim(F.col("text"), F.lit(_WHITE)), -1, 1)
    return rows.select("key", "turn", "role", "text", initial.cast("int").alias("initial"), (~F.col("text").rlike(_SOME)).alias("blank"), (~last.isin(".", "!", "?")).alias("unended"))


# --- costs and paths of a batch of groups of rows ------------------------------------------

class Paths:
    """Least repairs of groups of consecutive rows (whole conversations or pieces of one)."""

    def __init__(self, starts: np.ndarray, initial: np.ndarray, must: np.ndarray, unended: np.ndarray):
        n = len(initial)
        self.starts, self.lengths = starts, np.diff(np.append(starts, n))
        self.group = np.repeat(np.arange(len(starts)), self.lengths)
        self.base = starts + np.arange(len(starts))  # a group has one layer of nodes more than rows
        self.layer = np.arange(n) + self.group
        self.end = self.base + self.lengths
        self.cost = np.full((n, 4, 4), _FAR)
        self.to = np.zeros((n, 4, 4), np.int64)
        kept, extra, free = _KEPT[initial], 3 * unended, ~must
        self.cost[:, :, _DELETE], self.to[:, :, _DELETE] = 4, np.arange(4)
        self.cost[:, :, _KEEP] = np.where((kept >= 0) & free[:, None], extra[:, None], _FAR)
        self.to[:, :, _KEEP] = np.maximum(kept, 0)
        self.cost[:, :, _REROLE] = np.where(free, 3 + extra, _FAR)[:, None]
        self.to[:, :, _REROLE] = _NEXT

    def costs(self, ends: np.ndarray) -> np.ndarray:
        """Cost to go of every node; ``ends`` are those of each group's last layer."""
        go = np.full((len(self.layer) + len(self.starts), 4), _FAR)
        go[self.end] = ends
        order = np.argsort(-self.lengths, kind="stable")
        lengths = self.lengths[order]
        for back in range(1, int(lengths.max(initial=0)) + 1):
            some = order[: np.searchsorted(-lengths, -back, side="right")]
            row, layer = self.starts[some] + self.lengths[some] - back, self.end[some] - back
            behind = go[layer + 1]
            steps = self.cost[row] + behind[np.arange(len(some))[:, None, None], self.to[row]]
            best = steps.min(axis=2)
            turned = best.copy()  # with a turn inserted first
            for state in (2, 3):
                turned[:, state] = np.minimum(best[:, state], 3 + best[:, _NEXT[state]])
            for state in (0, 1):
                turned[:, state] = np.minimum(best[:, state], 3 + turned[:, 2])
            go[layer] = np.minimum(turned, _FAR)
        return go

    def solve(self, ends: np.ndarray, last: np.ndarray) -> None:
        """Ranks and doubled pointers for the given costs at the groups' ends; ``last``: nothing follows the group."""
        go = self.costs(ends)
        total = np.full((len(go), 4, 4), _FAR * 4)
        to = np.zeros((len(go), 4, 4), np.int64)
        reach = self.to + ((self.layer + 1) * 4)[:, None, None]
        total[self.layer] = self.cost + go.reshape(-1)[reach]
        to[self.layer] = reach
        total[:, :, _INSERT] = 3 + go[:, _NEXT]
        to[:, :, _INSERT] = (np.arange(len(go)) * 4)[:, None] + _NEXT
        total[self.end[~last]] = _FAR * 4
        optimal = (total == go[:, :, None]).reshape(-1, 4)
        to = to.reshape(-1, 4)
        nodes = np.arange(len(optimal))
        moves = optimal.any(axis=1)
        letter = optimal.argmax(axis=1)
        pointer = np.where(moves, to[nodes, letter], nodes)
        rank, far = np.where(moves, letter + 1, 0), pointer
        while (far != far[far]).any() or (far != pointer[far]).any():
            _, rank = np.unique(rank * (rank.max() + 1) + rank[far], return_inverse=True)
            far = far[far]
        # The arc taken: the least letter, then the least rank behind it.
        choice = np.where(optimal, np.arange(4) * (rank.max() + 1) + rank[to], np.iinfo(np.int64).max).argmin(axis=1)
        self.letter = choice
        self.pointers = [np.where(moves, to[nodes, choice], nodes)]
        self.steps = moves.astype(np.int64)
        while (self.pointers[-1] != self.pointers[0][self.pointers[-1]]).any():
            by = self.pointers[-1]
            self.steps = self.steps + self.steps[by]
            self.pointers.append(by[by])

    def exits(self) -> np.ndarray:
        """Per group and entry state the state behind the last row."""
        entry = self.base[:, None] * 4 + np.arange(4)
        return self.pointers[-1][entry] % 4

    def walk(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per step of all groups' paths: the edit, its row, the state behind it; and where each group's steps begin."""
        begin = self.base * 4 + entry
        sizes = self.steps[begin]
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        node = np.repeat(begin, sizes)
        nth = np.arange(len(node)) - np.repeat(cuts[:-1], sizes)
        for k, pointer in enumerate(self.pointers):
            node = np.where((nth >> k) & 1 == 1, pointer[node], node)
        row = node // 4 - np.repeat(np.arange(len(begin)), sizes)
        return self.letter[node], row, self.pointers[0][node] % 4, cuts


class Rows:
    """Consecutive rows of an Arrow table, cut into groups."""

    def __init__(self, table: pa.Table, by: list[str]):
        self.table = table
        keys = [table[c].to_numpy(zero_copy_only=False) for c in by]
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        self.starts = np.flatnonzero(new)
        self.heads = [k[self.starts] for k in keys]
        self.roles, self.texts = table["role"].to_pylist(), table["text"].to_pylist()
        self.initial = table["initial"].to_numpy()
        self.blank, self.unended = (table[c].to_numpy(zero_copy_only=False).astype(bool) for c in ("blank", "unended"))
        self.lengths = np.diff(np.append(self.starts, table.num_rows))
        if "again" in table.column_names:
            again = table["again"].to_numpy(zero_copy_only=False).astype(bool)
        else:
            again, seen = np.zeros(table.num_rows, bool), set()
            for i, row in enumerate(zip(np.repeat(np.arange(len(self.starts)), self.lengths).tolist(), self.roles, self.texts)):
                again[i] = row in seen
                seen.add(row)
        self.again = again & ~self.blank
        self.truncated = self.unended & ~self.again & ~self.blank
        # A deleted row costs nothing more, and a blank or repeated one is always deleted.
        self.paths = Paths(self.starts, self.initial, self.blank | self.again, self.truncated)

    def counts(self) -> dict[str, np.ndarray]:
        """Faults, illegal neighbours and what the gaps follow from, per group."""
        n, follows = len(self.blank), np.ones(len(self.blank), bool)
        follows[self.starts] = False
        legal = np.zeros((4, 4), bool)
        for a, b in _LEGAL:
            legal[a, b] = True
        wrong = np.zeros(n, bool)
        wrong[1:] = ~legal[self.initial[:-1], self.initial[1:]]
        turn = self.table["turn"]
        known = turn.is_valid().to_numpy(zero_copy_only=False)
        value = turn.fill_null(0).to_numpy()
        new = known.copy()  # null turns come first, so equal ones are neighbours
        new[1:] &= (value[1:] != value[:-1]) | ~known[:-1] | ~follows[1:]
        total = lambda x: np.add.reduceat(x.astype(np.int64), self.starts)
        ends = self.starts + self.lengths - 1
        some = total(known) > 0
        firsts = np.minimum(self.starts + self.lengths - total(known), ends)
        return {
            "blank": total(self.blank), "duplicate": total(self.again), "truncated": total(self.truncated), "illegal": total(wrong & follows),
            "distinct": total(new), "some": some, "low": np.where(some, value[firsts], 0), "high": np.where(some, value[ends], 0),
        }

    def repaired(self, entry: np.ndarray) -> tuple[list[str], list[list[str]]]:
        """Per group the audit and the lines ``role:text``."""
        edit, row, state, cuts = self.paths.walk(entry)
        letters = np.frombuffer(_LETTERS.encode(), np.uint8)[edit].tobytes().decode()
        lines: list[list[str]] = []
        edits, rows, states = edit.tolist(), row.tolist(), state.tolist()
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            own = []
            for i in range(lo, hi):
                if edits[i] == _INSERT:
                    own.append(_ROLE[states[i]] + ":")
                elif edits[i] != _DELETE:
                    own.append(f"{self.roles[rows[i]] if edits[i] == _KEEP else _ROLE[states[i]]}:{self.texts[rows[i]]}")
            lines.append(own)
        return [letters[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:])], lines


def _groups(batches, by: list[str]):
    """Rows of whole groups: those of a group cut by the end of a batch wait for the next one."""
    waiting: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        last = [table[c][-1].as_py() for c in by]
        same = np.ones(table.num_rows, bool)
        for c, value in zip(by, last):
            same &= table[c].to_numpy(zero_copy_only=False) == value
        cut = table.num_rows - int(same[::-1].argmin() if not same.all() else table.num_rows)
        if waiting and cut == 0 and [waiting[0][c][0].as_py() for c in by] == last:
            waiting.append(table)
            continue
        whole = [*waiting, table.slice(0, cut)]
        waiting = [table.slice(cut)]
        whole = [t for t in whole if t.num_rows]
        if whole:
            yield Rows(pa.concat_tables(whole).combine_chunks(), by)
    if waiting:
        yield Rows(pa.concat_tables(waiting).combine_chunks(), by)


_STATS = ("blank", "duplicate", "truncated", "illegal")
_DONE = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _whole(batches):
    for rows in _groups(batches, ["key"]):
        stats, n = rows.counts(), len(rows.starts)
        rows.paths.solve(np.tile(_FINAL, (n, 1)), np.ones(n, bool))
        cost = rows.paths.costs(np.tile(_FINAL, (n, 1)))[rows.paths.base, 0]
        audits, lines = rows.repaired(np.zeros(n, np.int64))
        gaps = np.where(stats["some"], stats["high"] - stats["low"] + 1 - stats["distinct"], 0)
        hashes = [hashlib.sha256("\n".join(own).encode()).hexdigest() for own in lines]
        columns = [rows.heads[0], gaps, *[stats[c] for c in _STATS], cost, audits, hashes]
        types = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in _DONE.split(", ")])


# --- conversations of any length, piece by piece -------------------------------------------

_PIECES = (
    "key string, piece long, blank long, duplicate long, truncated long, illegal long, distinct long, some boolean, low long, high long, "
    "first int, final int, matrix array<long>"
)


def _summaries(batches):
    for rows in _groups(batches, ["key", "piece"]):
        n, stats = len(rows.starts), rows.counts()
        matrix = np.stack([rows.paths.costs(np.tile(np.where(np.arange(4) == s, 0, _FAR), (n, 1)))[rows.paths.base] for s in range(4)], axis=2)
        ends = rows.starts + rows.lengths - 1
        columns = [rows.heads[0], rows.heads[1], *[stats[c] for c in (*_STATS, "distinct", "some", "low", "high")], rows.initial[rows.starts], rows.initial[ends]]
        types = [pa.string(), *[pa.int64()] * 6, pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types)] + [pa.array(matrix.reshape(n, 16).tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _PIECES.split(", ")])


def _chain(pieces: pd.DataFrame) -> pd.DataFrame:
    """From the last piece back: what the rest costs behind every piece."""
    pieces = pieces.sort_values("piece")
    ends, out = _FINAL, []
    for matrix in reversed(list(pieces["matrix"])):
        out.append(ends.tolist())
        ends = (np.asarray(matrix, np.int64).reshape(4, 4) + ends[None, :]).min(axis=1)
    return pd.DataFrame({"key": pieces["key"], "piece": pieces["piece"], "ends": out[::-1], "last": [False] * (len(out) - 1) + [True], "cost": int(ends[0])})


def _totals(pieces: pd.DataFrame) -> pd.DataFrame:
    pieces = pieces.sort_values("piece")
    between = list(zip(pieces["final"][:-1], pieces["first"][1:]))
    known = pieces[pieces["some"]]
    shared = int((known["high"].to_numpy()[:-1] == known["low"].to_numpy()[1:]).sum())
    gaps = int(known["high"].iloc[-1] - known["low"].iloc[0] + 1 - known["distinct"].sum() + shared) if len(known) else 0
    sums = {c: [int(pieces[c].sum())] for c in _STATS}
    sums["illegal"][0] += sum(pair not in _LEGAL for pair in between)
    return pd.DataFrame({"key": pieces["key"].iloc[:1], "gaps": [gaps], **sums})


def _entries(pieces: pd.DataFrame) -> pd.DataFrame:
    pieces = pieces.sort_values("piece")
    state, out = 0, []
    for exits in pieces["exits"]:
        out.append(state)
        state = int(exits[state])
    return pd.DataFrame({"key": pieces["key"], "piece": pieces["piece"], "entry": out})


def _solved(batches):
    for rows in _groups(batches, ["key", "piece"]):
        at = pa.array(rows.starts)
        ends = np.array(rows.table["ends"].take(at).to_pylist(), np.int64)
        rows.paths.solve(ends, rows.table["last"].take(at).to_numpy(zero_copy_only=False).astype(bool))
        yield rows, at


def _piece_exits(batches):
    for rows, _ in _solved(batches):
        arrays = [pa.array(rows.heads[0], pa.string()), pa.array(rows.heads[1], pa.int64()), pa.array(rows.paths.exits().tolist(), pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(arrays, ["key", "piece", "exits"])


def _piece_repairs(batches):
    for rows, at in _solved(batches):
        audits, lines = rows.repaired(rows.table["entry"].take(at).to_numpy())
        some = [bool(own) for own in lines]
        arrays = [
            pa.array(rows.heads[0], pa.string()), pa.array(rows.heads[1], pa.int64()), pa.array(audits, pa.string()),
            pa.array(["\n".join(own) for own in lines], pa.string()), pa.array(some),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["key", "piece", "audit", "lines", "some"])


def _read_in_order(batches):
    """One row per conversation: the audit and the hash of its lines, read piece by piece."""
    key, audit, digest, begun = None, [], hashlib.sha256(), False
    names = ["key", "audit", "repaired_sha256"]
    for batch in batches:
        for row in batch.to_pylist():
            if row["key"] != key:
                if key is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (key, "".join(audit), digest.hexdigest())], names)
                key, audit, digest, begun = row["key"], [], hashlib.sha256(), False
            audit.append(row["audit"])
            if row["some"]:
                digest.update((("\n" if begun else "") + row["lines"]).encode())
                begun = True
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (key, "".join(audit), digest.hexdigest())], names)


def _divided(rows: DataFrame, piece_rows: int) -> DataFrame:
    columns = ["key", "turn", "role", "text", "initial", "blank", "unended"]
    # Rows alike in everything are alike in what becomes of them; the last key only lets a sort split them.
    placed = in_order(rows.withColumn("tie", F.monotonically_increasing_id()), F.col("key"), F.asc_nulls_first("turn"), F.col("role"), F.col("text"), F.col("tie"))
    first = materialize(placed.groupBy("key").agg(F.min("position").alias("origin")), "origins")
    earliest = placed.groupBy("key", "role", "text").agg(F.min("position").alias("position")).select("position", F.lit(True).alias("new"))
    marked = lookup(placed.join(earliest, "position", "left"), first, "key")
    piece = F.floor((F.col("position") - F.col("origin")) / piece_rows).alias("piece")
    pieces = written(marked.select(*columns, "position", F.col("new").isNull().alias("again"), piece), "pieces")

    def by_piece(df: DataFrame) -> DataFrame:
        return df.repartition("key", "piece").sortWithinPartitions("key", "piece", "position")

    summary = materialize(by_piece(pieces).mapInArrow(_summaries, _PIECES), "summaries")
    ends = materialize(summary.select("key", "piece", "matrix").groupBy("key").applyInPandas(_chain, "key string, piece long, ends array<long>, last boolean, cost long"), "ends")
    stats = summary.drop("matrix").groupBy("key").applyInPandas(_totals, "key string, gaps long, blank long, duplicate long, truncated long, illegal long")
    ending = lookup(pieces, ends.drop("cost"), ["key", "piece"])
    exits = by_piece(ending).mapInArrow(_piece_exits, "key string, piece long, exits array<int>")
    entries = materialize(exits.groupBy("key").applyInPandas(_entries, "key string, piece long, entry int"), "entries")
    repairs = by_piece(lookup(ending, entries, ["key", "piece"])).mapInArrow(_piece_repairs, "key string, piece long, audit string, lines string, some boolean")
    joined = repairs.repartition("key").sortWithinPartitions("key", "piece").mapInArrow(_read_in_order, "key string, audit string, repaired_sha256 string")
    costs = ends.groupBy("key").agg(F.max("cost").alias("cost"))
    return stats.join(costs, "key").join(joined, "key").select([f.split()[0] for f in _DONE.split(", ")])


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Per key of ``rows`` (key, turn, role, text): gaps, counts of faults, cost, audit, repaired_sha256."""
    rows = written(_judged(rows), "rows")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    long = materialize(sizes.filter(F.col("n") > piece_rows).select("key"), "long")
    if long.isEmpty():
        short = rows
    else:
        short = lookup(rows, long, "key", "left_anti")
    ordered = short.repartition("key").sortWithinPartitions("key", F.asc_nulls_first("turn"), "role", "text")
    done = ordered.mapInArrow(_whole, _DONE)
    return done if long.isEmpty() else done.unionByName(_divided(lookup(rows, long, "key", "left_semi"), piece_rows))


def repair_conversations(conversations: DataFrame, rows: DataFrame | None = None, **options) -> DataFrame:
    """One row per id of ``conversations``; ``rows`` (key, turn, role, text) are repaired, by default its damaged rows."""
    ids = conversations.select("conv_id").distinct().withColumn("key", group_key())
    done = repair(damaged(conversations) if rows is None else rows, **options)
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *_STATS, "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return ids.join(done, "key", "left").select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")
    )
