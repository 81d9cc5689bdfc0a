import functools
import hashlib
import random
import re
import zlib

import pytest

from quarry.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, key string, piece int, position long"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        say = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def repaired(rows):
    """One conversation's result by trying every edit, from the rows' end."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, judged, counts = set(), [], [0, 0, 0]
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        judged.append((role, text, fault))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}

    @functools.cache
    def rest(i, state, inserted):
        options = [(0, "", ())] if i == len(judged) and state in ("", "a") else []
        if inserted < 2:
            for x in after[state].keys() & names.keys():
                c, a, lines = rest(i, x, inserted + 1)
                options.append((c + 3, "I" + a, (names[x] + ":", *lines)))
        if i < len(judged):
            role, text, fault = judged[i]
            c, a, lines = rest(i + 1, state, 0)
            options.append((c + 4, "D" + a, lines))
            if fault not in (0, 1):
                more = 3 if fault == 2 else 0
                if role[:1] in after[state]:
                    c, a, lines = rest(i + 1, role[:1], 0)
                    options.append((c + more, "K" + a, (f"{role}:{text}", *lines)))
                for x in after[state].keys() & names.keys():
                    c, a, lines = rest(i + 1, x, 0)
                    options.append((c + 3 + more, "R" + a, (f"{names[x]}:{text}", *lines)))
        return min(options, default=(10**9, "", ()))

    cost, audit, lines = rest(0, "", 0)
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    hurt = damage(rows)
    return {c: repaired([r for r in hurt if r[0] == c]) for c in {r[0] for r in rows}}


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        turn = 0
        for _ in range(rng.randint(1, longest)):
            turn += rng.choice([1, 1, 1, 2, 0])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "What?", "and then", "", " \n", None, f"Text {rng.random()}.", "End. \t", "ümlaut?"])
            rows.append((conv if rng.random() < 0.97 else None, turn if rng.random() < 0.9 else None, role, text))
    return rows


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA).repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in cr.repair_conversations(df, **options).collect()}
    assert len(got) == len({r[0] for r in rows})
    return got


@pytest.mark.parametrize("seed,longest", [(1, 9), (2, 25)])
def test_equals_trying_all_edits(spark, seed, longest):
    rows = conversations(seed, 60, longest)
    assert run(spark, rows) == expected(rows)


@pytest.mark.parametrize("piece_rows", [1, 3, 8])
def test_divided_conversations_give_the_same(spark, piece_rows):
    rows = conversations(3, 12, 30) + [(99, t, "user", "same.") for t in range(40)]
    assert run(spark, rows, piece_rows=piece_rows) == expected(rows)


def test_defined_cases(spark):
    rows = [(7, None, None, None), (8, 1, "user", None), (8, 1, "user", None), (None, None, "assistant", "Yes."), (9, 5, "user", "Hi."), (9, 9, "assistant", "Yes.")]
    assert run(spark, rows) == expected(rows)
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert run(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}
    assert cr.repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_text_and_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", "x" * 200_000 + ".") for t in range(4)] + [(2, t, "user", f"{t}.") for t in range(700)]
    got = run(spark, rows)
    assert got == run(spark, rows, piece_rows=100)
    assert got[1] == expected(rows[:4])[1]
