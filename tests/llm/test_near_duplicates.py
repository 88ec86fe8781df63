import random
import re

import cases
import pytest

from clickloom.llm.near_duplicates import linked_pairs, near_duplicates, prefix_length, without_near_duplicates


def sets(text, size=5):
    ws = re.findall("[^\x20\x09-\x0d]+", text or "")
    if not ws:
        return None
    return frozenset(tuple(ws[i : i + size]) for i in range(max(len(ws) - size + 1, 1)))


def brute(rows):
    """(doc_id, set_id, class_id, links) by comparing all pairs."""
    members = [(d, sets(t)) for d, t in rows]
    likeness = lambda a, b: len(a & b) / len(a | b)
    near = [[j for j, (_, b) in enumerate(members) if i != j and a and b and likeness(a, b) >= 0.8]
            for i, (_, a) in enumerate(members)]
    label = list(range(len(members)))
    for _ in members:
        label = [min([label[i], *(label[j] for j in near[i])]) for i in range(len(members))]
    low = lambda ids: min((d for d in ids if d is not None), default=None)
    out = []
    for i, (d, a) in enumerate(members):
        same = [e for e, b in members if b == a] if a else [d]
        out.append((d, low(same), low([members[j][0] for j in range(len(members)) if label[j] == label[i]]), len(near[i])))
    return sorted(out, key=str)


def edited(seed, base, edits):
    r, ws = random.Random(seed), base.split()
    for _ in range(edits):
        ws[r.randrange(len(ws))] = f"e{r.randrange(10**6)}"
    return " ".join(ws)


def test_prefix_is_shortened_to_the_target():
    assert prefix_length(0.8, 10, 6, 0.99) == 4
    assert prefix_length(0.8, 10, 6, 0.0) == 6
    assert prefix_length(0.3, 2, 6, 0.99) == 1


@pytest.mark.parametrize("block", [256, 7])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr("clickloom.llm.near_duplicates.BLOCK", block)
    rows = cases.rows()
    base = cases.prose(77, 200)
    rows += [(200 + i, edited(i, base, 1 + i % 3), *[None] * 5) for i in range(25)]
    rows += [(300 + i, edited(i, cases.prose(78 + i % 4, 90), 1), *[None] * 5) for i in range(12)]
    rows += [(400 + i, base, *[None] * 5) for i in range(3)]
    members = near_duplicates(cases.docs(spark, rows), trees=40)  # enough trees to find all of so few
    found = sorted(((r.doc_id, r.set_id, r.class_id, r.n_links) for r in members.collect()), key=str)
    want = brute([r[:2] for r in rows])
    assert found == want
    if block == 7:
        return
    pairs = [(r.a, r.b) for r in linked_pairs(cases.docs(spark, rows), trees=40).collect()]
    assert len(pairs) == len(set(pairs)) > 100
    kept = without_near_duplicates(cases.docs(spark, rows), trees=40)
    assert kept.columns == cases.docs(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    classes = {w[2] for w, r in ((w, None) for w in want)}
    assert {i for i in ids if i is not None} >= {c for c in classes if c is not None}
    assert sum(i is not None for i in ids) == len({i for i in ids if i is not None})


def test_empty_table(spark):
    assert near_duplicates(cases.docs(spark, [])).count() == 0
    assert without_near_duplicates(cases.docs(spark, [])).count() == 0
