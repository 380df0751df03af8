from __future__ import annotations

import hashlib
import random
import re

from priceflow.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute_force(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found)


PARTS = ["a", "b.", "@", ".", "1", "12", "+1", " ", "-", "(", ")", "255", "4111 1111 1111 1111", "x@y.zz", "300.1.2.3", "é", "007.1.1.1", "\n"]


def test_base_spans_are_those_of_brute_force(docs_of):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    for text in texts:
        assert pii.base_spans(text) == brute_force(text)
    some = [*texts[:200], "", None]
    for row in pii.op10_personal_data(docs_of(*some)).collect():
        spans = brute_force(some[row.doc_id] or "")
        expected = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert row.base_sha256 == hashlib.sha256(expected.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "+1" + " " * 300_000, "1." * 150_000, "@" * 300_000):
        pii.base_spans(text)


def test_contexts_discover_identifiers(docs_of):
    known = [f"Hello, write to my mail user{i}@site{i % 5}.com today." for i in range(30)]
    unseen = [f"Hello, write to my mail user{i}@intranet today." for i in range(20)]
    other = [f"The order number is {i}77A and room {i}00B." for i in range(30)]
    texts = known + unseen + other
    rows = {r.doc_id: r.spans for r in pii.op10_personal_data(docs_of(*texts)).collect()}
    for i in range(30):
        assert rows[i].startswith("email:")
    for i in range(30, 50):
        start = texts[i].index("user")
        assert rows[i] == f"email:{start}:{start + len(f'user{i - 30}@intranet')}"
    assert {rows[i] for i in range(50, 80)} == {""}
    assert pii.op10_personal_data(docs_of((1, "x")).where("false")).count() == 0
