"""Best-fit packing of documents into sequences, in bulk-synchronous rounds.

1. Texts are tokenised where they lie and cut into pieces of at most ``max_tokens``.
2. Pieces are range-sorted by length over all tasks.  A range holds few lengths, so the
   sorted list is described by its runs, (range, length, count): at most ``max_tokens``
   lengths and one more run per range, whatever the size of the corpus.
3. Rounds over the run-length code of both sorted lists, documents and gaps: every
   document length finds its successor, the smallest gap that holds it; where lengths meet
   at one gap size, rank decides (longer first, then order in the sorted list); the gaps
   taken shrink, and the next round sees them.  A document without successor opens a
   sequence.  Equal documents are interchangeable, so a round moves whole intervals of
   ranks at once and its cost does not depend on how many rows a run stands for.
4. Every piece looks up the interval its rank lies in, where it lies.

The rounds run on the driver because their input is bounded by ``max_tokens``, not by the
data; tokenising, sorting, ranking and placing are distributed.  No length, however
frequent, meets in one task: ranges split a length by document.

Defined results: a null or empty text is the end token alone; a null ``doc_id`` sorts
first and is returned as it is; repeated rows are packed each for itself; an empty table
gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.queries import query
from clickloom.llm.shared import id_and_text, small_batches, table, written
from clickloom.llm.textcore import chunks, lists, span_hashes, words

MAX_TOKENS = 4096
END_ID = 1
# Stretches a worker remembers, about 30 bytes each.
REMEMBERED = 1 << 20
# Bytes of a longer text that are looked at together.
PART_BYTES = 1 << 21


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ASCII white space.
WHITE = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")


def text_parts(text: bytes, limit: int = PART_BYTES) -> Iterator[bytes]:
    """The text in parts of about ``limit`` bytes that end with a stretch; a longer stretch stays whole."""
    at = 0
    while len(text) - at > limit:
        cut = max(text.rfind(c, at, at + limit) for c in WHITE)
        if cut <= at:
            cut = min((p for c in WHITE if (p := text.find(c, at + limit)) >= 0), default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


class WordIds:
    """Ids of the stretches between ASCII white space.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of
    its stretches one after another.  Stretches are known by 64-bit hashes in sorted
    arrays, with their ids in a pool: texts are looked up whole, by NumPy.  Past
    ``remembered`` stretches the half that was used longest ago is forgotten.

    Latin letters followed by ASCII signs are two pieces to the tokenizer as well, and case
    is folded, so a new stretch is put together from its letters and its signs.
    """

    # Letters whose lower case is one letter, and signs that join no letter.
    PLAIN = re.compile("([A-Za-zÀ-ÖØ-Þß-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")
    # Stands between pieces that are encoded in one call; without it in a piece none gives its id.
    BORDER = "!"

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer, self.remembered = Tokenizer.from_file(path), remembered
        self.border = self.tokenizer.encode(self.BORDER, add_special_tokens=False).ids
        self.keys, self.pool, self.now = np.zeros(0, np.uint64), np.zeros(0, np.uint32), 0
        self.first, self.count, self.used = (np.zeros(0, np.int32) for _ in range(3))

    def _one_by_one(self, new: list[str]) -> dict[str, bytes]:
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        return {text: np.array(e.ids, "<u4").tobytes() for text, e in zip(new, found, strict=True)}

    def _encoded(self, new: list[str], at_once: int = 4000) -> list[bytes]:
        """Ids of pieces without white space, many in one text with borders between them."""
        out = self._one_by_one([x for x in new if self.BORDER in x] if len(self.border) == 1 else new)
        rest = [x for x in new if x not in out]
        for low in range(0, len(rest), at_once):
            own = rest[low : low + at_once]
            text = f" {self.BORDER} ".join(own)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = 4 * np.flatnonzero(ids == self.border[0])
            if len(ends) != len(own) - 1:
                out.update(self._one_by_one(own))
                continue
            raw = ids.tobytes()
            out.update(
                (x, raw[a:b]) for x, a, b in zip(own, [0, *(ends + 4).tolist()], [*ends.tolist(), len(raw)], strict=True)
            )
        return [out[x] for x in new]

    def _put_together(self, new: list[str]) -> list[bytes]:
        """Ids of new stretches from those of their letters and signs."""
        split = [(m[1].lower(), m[2]) if m else (x, "") for x, m in zip(new, map(self.PLAIN.fullmatch, new), strict=True)]
        parts = list({y for pair in split for y in pair} - {""})
        data = np.frombuffer(" ".join(parts).encode(), np.uint8)
        first, count = self._look_up(data, *words(data, np.array([0, len(data)]))[:2], self._encoded)
        raw = self.pool.tobytes()
        made = {x: raw[4 * a : 4 * (a + n)] for x, a, n in zip(parts, first.tolist(), count.tolist(), strict=True)} | {"": b""}
        return [made[a] + made[b] for a, b in split]

    def _look_up(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray, make) -> tuple[np.ndarray, np.ndarray]:
        """(first, count) in the pool of the ids of every span; ``make`` gives those of spans not known yet."""
        hashes, at, which = np.unique(span_hashes(data, start, stop), return_index=True, return_inverse=True)
        new = self._unknown(hashes)
        if new.any():
            raw = data.tobytes()
            made = make([raw[a:b].decode() for a, b in zip(start[at[new]].tolist(), stop[at[new]].tolist(), strict=True)])
            still = self._unknown(hashes)  # some may have been met as parts of others
            made = [m for m, x in zip(made, still[new].tolist(), strict=True) if x]
            size = np.array([len(m) // 4 for m in made], np.int32)
            where = np.searchsorted(self.keys, hashes[still])
            self.keys = np.insert(self.keys, where, hashes[still])
            self.first = np.insert(self.first, where, len(self.pool) + np.cumsum(size, dtype=np.int32) - size)
            self.count, self.used = np.insert(self.count, where, size), np.insert(self.used, where, self.now)
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(made), "<u4")])
        place = np.searchsorted(self.keys, hashes)
        self.used[place] = self.now
        return self.first[place][which], self.count[place][which]

    def _unknown(self, hashes: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.keys, hashes)
        new = np.ones(len(hashes), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != hashes[inside]
        return new

    def _forget(self) -> None:
        kept = np.flatnonzero(self.used >= np.median(self.used)) if len(self.keys) else np.zeros(0, int)
        kept = kept[: self.remembered // 2]
        self.pool = self.pool[spread(self.first[kept], self.count[kept])]
        self.keys, self.count, self.used = self.keys[kept], self.count[kept], self.used[kept]
        self.first = (np.cumsum(self.count) - self.count).astype(np.int32)

    def of(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of UTF-8 rows one after another, and where each row's begin (one more entry than rows)."""
        start, stop, word = words(data, starts)
        self.now += 1
        if len(self.keys) > self.remembered:
            self._forget()
        first, count = self._look_up(data, start, stop, self._put_together)
        total = np.zeros(len(count) + 1, np.int64)
        np.cumsum(count, out=total[1:])
        return self.pool[spread(first, count)], total[word]

    def of_rows(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, some bytes at a time."""
        for lo, hi, data, starts in chunks(column):
            if hi - lo == 1 and len(data) > PART_BYTES:
                parts = [np.frombuffer(p, np.uint8) for p in text_parts(data.tobytes())]
                yield np.concatenate([self.of(p, np.array([0, len(p)]))[0] for p in parts])
                continue
            ids, begin = self.of(data, starts)
            yield from (ids[a:b] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True))


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices first, first + 1, ... of each run of ``count``, one run after another."""
    ends = np.cumsum(count, dtype=np.int64)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - count), count)


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer of this worker process, kept between tasks."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenised_pieces(
    docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``max_tokens`` ids of every document, with the ids themselves on demand.

    Only longer documents are cut: all pieces but the last are full.
    """
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(tokenizer)
        for batch in batches:
            rows, parts = [], []
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), ids.of_rows(batch.column("text")), strict=True):
                own = np.concatenate([own, end])
                for piece, at in enumerate(range(0, len(own), max_tokens)):
                    part = own[at : at + max_tokens]
                    rows.append((doc_id, piece, at, len(part), zlib.crc32(part)))
                    if with_ids:
                        parts.append(part)
            columns = [
                pa.array(c, t)
                for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), *[pa.int64()] * 3), strict=True)
            ] or [pa.array([], t) for t in (pa.int64(), pa.int32(), *[pa.int64()] * 3)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                first = np.cumsum([0, *map(len, parts)])
                flat = np.concatenate([np.zeros(0, "<u4"), *parts])
                columns.append(lists(flat.astype(np.int32), first, pa.int32()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = PIECE + (", ids array<int>" if with_ids else "")
    return id_and_text(docs).mapInArrow(run, schema)


def range_sorted(pieces: DataFrame) -> DataFrame:
    """Pieces sorted by length over all tasks, each with its range and its index among its length there."""
    order = [F.col("length").desc(), F.col("doc_id"), F.col("piece")]
    spread = pieces.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            change = np.flatnonzero(np.r_[True, length[1:] != length[:-1]])
            index = np.arange(len(length)) - np.repeat(change, np.diff(np.r_[change, len(length)]))
            if length[0] == last:
                index[: change[1] if len(change) > 1 else len(index)] += n
            last, n = length[-1], int(index[-1]) + 1
            yield batch.append_column("range", pa.array(np.full(len(length), part, np.int32))).append_column(
                "index", pa.array(index.astype(np.int64))
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return spread.mapInArrow(run, f"{fields}, range int, index long")


def pack_lengths(counts: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[int, int, int, int, int, int]]:
    """Bulk-synchronous best-fit over run-length codes.

    ``counts``: documents of each length.  Returns placements (length, first rank, ranks,
    ranks a sequence, first sequence, offset): rank ``first + i`` goes to sequence
    ``first sequence + i // ranks a sequence``.

    Bands of lengths go from long to short, each within a factor of two: long documents
    open sequences and short ones fill them, and within a band a gap takes few documents.
    """
    left = {k: n for k, n in counts.items() if n}
    ranked = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}
    placed, opened = [], 0

    def place(length: int, gap: int, most: int) -> int:
        """Up to ``most`` documents of a length into sequences of a gap, one interval of sequences at a time."""
        done = 0
        while done < most and gaps.get(gap):
            first, n = gaps[gap].pop()
            todo = most - done
            each = max(1, min(gap // length, todo // n))
            used = min(n, todo // each)
            placed.append((length, ranked[length], used * each, each, first, max_tokens - gap))
            if used < n:
                gaps[gap].append((first + used, n - used))
            if gap > each * length:
                gaps.setdefault(gap - each * length, []).append((first, used))
            ranked[length] += used * each
            left[length] -= used * each
            done += used * each
        if not gaps.get(gap):
            gaps.pop(gap, None)
        return done

    while left:
        top = max(left)
        band = sorted((k for k in left if 2 * k > top), reverse=True)
        while band:
            sizes = sorted(gaps)
            # Every length finds its successor among the gaps as they stand at the start of the round.
            wanted: dict[int, list[int]] = {}
            for length in band:
                at = bisect_left(sizes, length)
                if at < len(sizes):
                    wanted.setdefault(sizes[at], []).append(length)
            if not wanted:
                # Nothing fits: as many sequences as these documents need at least.
                need = -(-sum(k * left[k] for k in band) // max_tokens)
                gaps[max_tokens] = [(opened, need)]
                opened += need
                continue
            for gap, lengths in wanted.items():
                for length in lengths:  # longer ones rank first
                    if not gaps.get(gap):
                        break
                    place(length, gap, left[length])
            for length in [k for k in band if not left[k]]:
                del left[length]
            band = [k for k in band if k in left]
    return placed


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset), one row per piece."""
    spark = docs.sparkSession
    pieces = tokenised_pieces(docs, tokenizer or default_tokenizer(), max_tokens, end_id, with_ids)
    ranked = written(range_sorted(written(pieces, "pieces")), "ranked-pieces")
    # One row per range and length met there: at most max_tokens lengths and one more row per range.
    runs = sorted((r["length"], r["range"], r["n"]) for r in ranked.groupBy("length", "range").agg(
        F.count("*").alias("n")).collect())
    counts: dict[int, int] = {}
    base = []
    for length, part, n in runs:
        base.append(((length << 32) + part, counts.get(length, 0)))
        counts[length] = counts.get(length, 0) + n
    placed = np.array(sorted(pack_lengths(counts, max_tokens)), np.int64).reshape(-1, 6)
    bases = np.array(base, np.int64).reshape(-1, 2)
    known = spark.sparkContext.broadcast((bases, placed, (placed[:, 0] << 44) + placed[:, 1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases, placed, keys = known.value
        for batch in batches:
            length, part, index = (batch.column(c).to_numpy() for c in ("length", "range", "index"))
            rank = bases[np.searchsorted(bases[:, 0], (length << 32) + part), 1] + index
            at = placed[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            step = rank - at[:, 1]
            batch = batch.select([c for c in batch.schema.names if c not in ("range", "index")])
            yield batch.append_column("sequence_id", pa.array(at[:, 4] + step // at[:, 3])).append_column(
                "offset", pa.array(at[:, 5] + step % at[:, 3] * length)
            )

    fields = [f for f in ranked.schema.fields if f.name not in ("range", "index")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


@query("op3_best_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
