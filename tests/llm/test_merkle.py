import hashlib
import zlib

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import merkle
from clickloom.llm import sha256_states as sha


def digest(*values):
    h = hashlib.sha256()
    for v in values:
        h.update(b"-" if v is None else f"{len(str(v).encode())}:{v}".encode())
    return h.hexdigest()


def joined(digests):
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def climb(nodes):
    """The root, and of every node its siblings: left and right of it, level by level."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, p in zip(paths, place, strict=True):
            a = p - p % 3
            path.append((nodes[a:p], nodes[p + 1 : a + 3]))
        nodes = [joined(nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        place = [p // 3 for p in place]
    return nodes[0], paths


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    rows = sorted(
        ((d, t, la, s, n, digest(d, s, la, n, t)) for d, t, la, s, n in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[5])
    )
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([r[5] for r in rows if r[3] == s]) for s in sources}
    root, upper = climb([trees[s][0] for s in sources])
    out = []
    for s, above in zip(sources, upper, strict=True):
        for r, path in zip([r for r in rows if r[3] == s], trees[s][1], strict=True):
            d, t, la, _, n, own = r
            hit = zlib.crc32(b"" if d is None else str(d).encode()) % 2 == 0
            now = digest(d, s, la, n, t.replace("\n", "") if hit and t is not None else t)
            for left, right in path + above:
                now = joined([*left, now, *right])
            beside = [x for left, right in path + above for x in left + right]
            out.append((d, own, trees[s][0], root, joined(beside), now, now == root))
    return sorted(out, key=str)


def changed():
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return F.when(F.crc32(number) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def columns(df):
    found = df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(map(tuple, found.collect()), key=str)


def test_states_against_hashlib():
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(9)]
    words = sha.words_of(digests)
    state = sha.start(3)
    for part in (words[:3], words[3:6], words[6:]):
        state = sha.read(state, part)
    found = sha.finish(state, np.array([3, 3, 3]))
    want = [hashlib.sha256((digests[i].hex() + digests[i + 3].hex() + digests[i + 6].hex()).encode()).digest() for i in range(3)]
    assert sha.bytes_of(found) == want


@pytest.mark.parametrize("levels", [2, 6])
def test_against_brute_force(spark, levels):
    rows = cases.rows()
    for s in range(14):  # sources of 1, 2, 3, 4, 9, 10, 27, 28, ... rows
        n = [1, 2, 3, 4, 9, 10, 27, 28, 81, 82, 5, 1, 1, 30][s]
        rows += [(1000 * (s + 1) + i, f"te\nxt {i}" if i % 3 else f"text {i}", "en", f"ñs{s}", i, "h", i) for i in range(n)]
    docs = cases.docs(spark, rows)
    for name in ("grp", "at", "n", "block", "path", "leaf", "row", "present"):
        docs = docs.withColumn(name, F.lit("x"))
    found = columns(merkle.manifest(docs, changed(), levels=levels))
    want = brute([r[:5] for r in rows])
    assert found == want
    assert 0 < sum(r[6] for r in found) < len(found)


def test_proof_leads_to_the_root(spark):
    rows = [(i, f"text {i}", None, f"s{i % 2}", None, None, None) for i in range(60)]
    for r in merkle.manifest(cases.docs(spark, rows)).collect():
        assert r.verified and joined(r.proof) == r.proof_sha256 and r.folded_root == r.root


def test_one_row_and_none(spark):
    only = merkle.manifest(cases.docs(spark, [(5, "a\nb", None, None, None, None, None)]), changed()).collect()[0]
    assert only.leaf == only.subroot == only.root and only.proof == [] and only.proof_sha256 == joined([])
    assert merkle.manifest(cases.docs(spark, [])).count() == 0
