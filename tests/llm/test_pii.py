import hashlib
import random
import re

from corpus_data import awkward, empty

from quarry.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The base spans by the patterns as they stand."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    alphabet = "0123456789.@+-() ab_%é١\n"
    for n in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        assert pii.joined(pii.base_spans(text)) == plain(text), repr(text)
    cards = "4111111111111111 4111 1111-1111 1111 x 4111111111111112 00000000000000000000"
    assert pii.joined(pii.base_spans(cards)) == plain(cards)


def test_long_runs_take_no_square_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" + " " * 200_000):
        pii.base_spans(text)


def test_repeats_of_an_entity_are_added():
    texts = ["call +1 (437) 555-0689 or bob@site.org", "id 4929963689861572 and 10.0.0.1"] * 40 + ["order 123456789 of 55555555555"] * 40
    field = pii.train(texts)
    text = "Call +1 (437) 555-0689. Again: (437) 555-0689. Mail bob@site.org, that is bob (at) site.org. Order 998877665."
    base, added = pii.find(text, field)
    found = {text[b:e] for spans in added for b, e in spans}
    assert {"bob (at) site.org"} <= found and "998877665" not in found
    assert pii.joined(base) == plain(text)
    assert [text[b:e] for b, e in added[3]] == ["(437) 555-0689"]


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = pii.spans_of(docs, pii.fit(docs)).collect()
    assert len(got) == docs.count()
    assert all(r.base == plain(r.row.text or "") for r in got)
    assert pii.spans_of(empty(spark), pii.fit(empty(spark))).count() == 0
    nothing = hashlib.sha256(b"").hexdigest()
    assert nothing.startswith("e3b0c442")


def test_long_runs_of_zeros():
    for text in ("0" * 5000 + ".1.1.1", "1.1." + "0" * 9000 + "7.255", "x" + "0" * 6000 + "256.1.1.1", "9" * 5000 + ".1.1.1"):
        spans = pii.base_spans(text)[1]
        assert len(spans) == (0 if "256" in text or "9" in text else 1)


def test_many_nodes_in_one_text_take_proportional_time():
    import time

    text = "a@b.c 555 123 4567 " * 10_000
    begin = time.perf_counter()
    found = pii.nodes(text, pii.base_spans(text))
    assert len(found.spans) == 20_000 and time.perf_counter() - begin < 20
