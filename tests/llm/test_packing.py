import zlib
from bisect import bisect_left, insort

import cases
import numpy as np
import pytest
from tokenizers import Tokenizer

from clickloom.llm.packing import default_tokenizer, pack, pack_lengths


def best_fit_decreasing(lengths, size):
    gaps, bins = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect_left(gaps, n)
        gap = gaps.pop(at) if at < len(gaps) else size
        bins += at == len(gaps) and gap == size
        insort(gaps, gap - n)
    return bins


@pytest.mark.parametrize("seed", range(5))
def test_rounds_fill_as_well_as_best_fit_decreasing(seed):
    r = np.random.default_rng(seed)
    lengths = np.minimum(4096, (r.lognormal(4 + seed, 1.2, 5000)).astype(int) + 1)
    counts = dict(zip(*[x.tolist() for x in np.unique(lengths, return_counts=True)], strict=True))
    placed = pack_lengths(counts)
    used, ranks = {}, {n: [] for n in counts}
    for length, first, n, each, seq, offset in placed:
        ranks[length].append((first, n))
        for i in range(n):
            used.setdefault(seq + i // each, []).append((offset + i % each * length, length))
    for length, parts in ranks.items():
        at = 0
        for first, n in sorted(parts):
            assert first == at
            at += n
        assert at == counts[length]
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    # The exact sequential order is the yardstick; rounds may differ by the last few sequences.
    assert len(used) <= best_fit_decreasing(lengths.tolist(), 4096) * 1.01 + 2


def test_pieces_and_ids(spark):
    tokenizer = Tokenizer.from_file(default_tokenizer())
    found = pack(cases.docs(spark), max_tokens=512, with_ids=True).collect()
    want = []
    for doc_id, text, *_ in cases.rows():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 512)):
            part = ids[at : at + 512]
            want.append((doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), part))
    assert sorted((tuple(r)[:6] for r in found), key=str) == sorted(want, key=str)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 512


def test_empty_table(spark):
    assert pack(cases.docs(spark, [])).count() == 0


def test_ids_are_the_tokenizers_whatever_is_forgotten():
    import random

    import pyarrow as pa

    from clickloom.llm.packing import PART_BYTES, WordIds

    r = random.Random(9)
    signs = "abcXYZäßÉ0123456789!?.,'-_()<|>½ﬁİς́　\x85\x1c漢字😀"
    texts = [" ".join("".join(r.choice(signs) for _ in range(r.randrange(1, 9))) for _ in range(r.randrange(60))) for _ in range(300)]
    texts += [None, "", " \t\n", "!", "! !", "<|endoftext|> it's DON'T", "x" * 5000]
    plain = Tokenizer.from_file(default_tokenizer())
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    for remembered in (40, 1 << 20):
        ids = WordIds(default_tokenizer(), remembered)
        for low in range(0, len(texts), 50):
            found = [x.tolist() for x in ids.of_rows(pa.array(texts[low : low + 50], pa.string()))]
            assert found == want[low : low + 50]
        assert remembered > 40 or len(ids.keys) < 4000
    long = " ".join(texts[i % 300] for i in range(PART_BYTES // 80))
    assert len(long.encode()) > PART_BYTES
    found = list(ids.of_rows(pa.array(["a b", long, None])))
    assert found[1].tolist() == plain.encode(long, add_special_tokens=False).ids and len(found) == 3
