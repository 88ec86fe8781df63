import hashlib
import re
from collections import defaultdict

import cases
import pytest

from clickloom.llm.exact_dedup import exact_duplicates


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        plain = re.sub("[\x20\x09-\x0d]", "", text or "")
        groups[hashlib.sha256(plain.encode()).hexdigest()].append((-len(text or ""), doc_id is None, doc_id or 0))
    out = []
    for sha, members in groups.items():
        best = min(members)
        kept = False
        for less, none, doc_id in sorted(members):
            out.append((None if none else doc_id, None if best[1] else best[2], len(members), not kept, sha))
            kept = True
    return sorted(out, key=str)


@pytest.mark.parametrize("fan_in", [2, 16])
def test_against_brute_force(spark, fan_in):
    docs = cases.docs(spark)
    found = sorted(map(tuple, exact_duplicates(docs, fan_in).collect()), key=str)
    assert found == brute([(r[0], r[1]) for r in cases.rows()])


def test_empty_table(spark):
    assert exact_duplicates(cases.docs(spark, [])).count() == 0
