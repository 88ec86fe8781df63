"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1.  One binary classifier per bit, a naive Bayes
over hashed two- and three-byte grams, tells the languages of one sign from those of the
other; its log odds per gram become a margin by a fit of two normal distributions.  A text
gets the language whose codeword loses least over all margins, every bit weighted by how
seldom it erred in training; a text is ambiguous if the runner-up loses hardly more.

Gram counts cover every training text: documents with a language whose crc32(doc_id as
text) mod 5 is not 0.  Margins and weights are fitted on a bounded sample of these,
``calibrate`` rows, taken by a hash of the id.  Predictions read the text alone.

Defined results: a null text or one without letter is ``und`` with score 0, and so is
everything if there is nothing to learn from; a single language wins with score 1;
repeated rows are judged each for itself; a null id counts as empty text for the fold.  An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.queries import query
from clickloom.llm.shared import fold, small_batches, table
from clickloom.llm.textcore import LOWER, chunks, mix

GRAMS = 1 << 14
CALIBRATE = 20_000
EXHAUSTIVE = 6
MIN_GAP = 0.5
UNDETERMINED = "und"

# Letters and all bytes of longer characters stay, everything else is a space.
KIND = np.where(((LOWER >= 97) & (LOWER <= 122)) | (LOWER >= 128), LOWER, 32).astype(np.uint32)
ASCII_LETTER = (KIND > 32) & (KIND < 128)


def codewords(n: int) -> np.ndarray:
    """One row per language, pairwise far apart: all splits of few languages, fixed random ones of many."""
    if n <= EXHAUSTIVE:
        splits = np.arange(1, 1 << max(n - 1, 0))
        return np.where((splits[None, :] >> np.arange(n)[:, None]) & 1, 1, -1)
    bits = 8 * int(np.ceil(np.log2(n)))
    value = mix((np.arange(n)[:, None] * 1000 + np.arange(bits)).astype(np.uint64))
    return np.c_[np.where(np.argsort(np.argsort(value, 0), 0) < n // 2, 1, -1), 2 * np.eye(n, dtype=int) - 1]


def grams(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashed gram at each byte, two-byte grams first, then three-byte ones; ``GRAMS`` where a row ends."""
    x = KIND[data]
    pair, triple = np.full(len(x), GRAMS, np.uint32), np.full(len(x), GRAMS, np.uint32)
    pair[:-1] = ((x[:-1] << 8 | x[1:]) * np.uint32(0x9E3779B1)) >> np.uint32(18)
    triple[:-2] = ((x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(0x85EBCA6B)) >> np.uint32(18)
    rows = starts[1:][np.diff(starts) > 0]
    pair[rows - 1] = GRAMS
    triple[rows - 1] = GRAMS
    triple[np.maximum(rows - 2, 0)] = GRAMS
    return np.stack([pair, triple])


def row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all training texts, map side first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lo, hi, data, starts in chunks(batch.column("text")):
                found = grams(data, starts)
                for lang in set(langs[lo:hi]):
                    mine = np.repeat(langs[lo:hi] == lang, np.diff(starts))
                    counts.setdefault(lang, np.zeros(GRAMS + 1, np.int64))
                    counts[lang] += np.bincount(found[:, mine].ravel(), minlength=GRAMS + 1)
        for lang, n in counts.items():
            at = np.flatnonzero(n[:GRAMS])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["lang", "gram", "n"]
            )

    found = docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray
    odds: np.ndarray
    slope: np.ndarray = field(default=None)
    middle: np.ndarray = field(default=None)
    weight: np.ndarray = field(default=None)

    def raw(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log odds per gram of every row and bit."""
        found = grams(data, starts)
        n = np.maximum(row_sums((found < GRAMS).sum(0), starts), 1)
        return np.stack([row_sums(odds[found[0]] + odds[found[1]], starts) / n for odds in self.odds], 1)

    def decode(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its share of exp(-loss), and how much more the next one loses."""
        rows = len(starts) - 1
        if len(self.langs) == 1:
            return np.zeros(rows, int), np.ones(rows), np.full(rows, np.inf)
        margin = np.clip(self.slope * (self.raw(data, starts) - self.middle), -30, 30)
        loss = np.stack([(np.log1p(np.exp(-margin * word)) * self.weight).sum(1) for word in self.code], 1)
        order = np.sort(loss, 1)
        share = 1 / np.exp(order[:, :1] - loss).sum(1)
        return loss.argmin(1), share, order[:, 1] - order[:, 0]


def with_letter(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether each row has a letter; only rows without an ASCII one are decoded."""
    out = row_sums(ASCII_LETTER[data], starts) > 0
    for row in np.flatnonzero(~out & (row_sums(data >= 128, starts) > 0)):
        out[row] = any(map(str.isalpha, data[starts[row] : starts[row + 1]].tobytes().decode()))
    return out


def calibrated(model: Model, docs: DataFrame, rows: int, calibrate: int) -> Model:
    """Margins and bit weights from a sample of at most about ``calibrate`` training texts."""
    share = min(1.0, calibrate / max(rows, 1))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20)))
    where, bits = {lang: i for i, lang in enumerate(model.langs)}, model.code.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([where[x] for x in batch.column("lang").to_pylist()], int)
            for lo, hi, data, starts in chunks(batch.column("text")):
                raw = model.raw(data, starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(lang[lo:hi], bits)), pa.array(np.tile(np.arange(bits), hi - lo)), pa.array(raw.ravel())],
                    names=["lang", "bit", "raw"],
                )

    found = sample.select("lang", "text").mapInArrow(run, "lang long, bit long, raw double")
    stats = found.groupBy("lang", "bit").agg(
        F.count("*").alias("n"), F.avg("raw").alias("mean"), F.var_pop("raw").alias("variance")
    )
    n, mean, variance = (np.zeros((len(model.langs), bits)) for _ in range(3))
    for r in stats.collect():
        n[r["lang"], r["bit"]], mean[r["lang"], r["bit"]], variance[r["lang"], r["bit"]] = r["n"], r["mean"], r["variance"]
    model.slope, model.middle, model.weight = np.ones(bits), np.zeros(bits), np.ones(bits)
    for b in range(bits):
        plus, minus = (n[:, b] > 0) & (model.code[:, b] > 0), (n[:, b] > 0) & (model.code[:, b] < 0)
        if not plus.any() or not minus.any():
            continue
        high, low = mean[plus, b].mean(), mean[minus, b].mean()
        spread = np.sqrt(variance[plus | minus, b].mean() + 1e-6)
        model.middle[b] = (mean[plus, b].min() + mean[minus, b].max()) / 2
        model.slope[b] = max(high - low, 1e-6) / spread**2
        # How far the nearest languages of either sign lie apart stands for how seldom the bit errs.
        apart = max((mean[plus, b].min() - mean[minus, b].max()) / (2 * spread), 0)
        model.weight[b] = 0.1 + min(apart, 3) / 3
    return model


def train(docs: DataFrame, calibrate: int = CALIBRATE) -> Model | None:
    """The model, or nothing if no training text has a language."""
    docs = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold() != 0))
    counts = gram_counts(docs).toPandas()  # at most one row per language and gram
    if counts.empty:
        return None
    langs = sorted(counts["lang"].unique())
    share = np.full((len(langs), GRAMS + 1), 0.5)
    share[[langs.index(x) for x in counts["lang"]], counts["gram"]] += counts["n"]
    share[:, GRAMS] = 0
    share /= share.sum(1, keepdims=True)
    code = codewords(len(langs))
    odds = np.zeros((code.shape[1], GRAMS + 1))
    for b in range(code.shape[1]):
        odds[b, :GRAMS] = np.log(share[code[:, b] > 0, :GRAMS].mean(0)) - np.log(share[code[:, b] < 0, :GRAMS].mean(0))
    model = Model(langs, code, odds.astype(np.float32))
    if len(langs) > 1:
        rows = docs.count()
        model = calibrated(model, docs, rows, calibrate)
    return model


def judged(column: pa.Array, model: Model | None, min_gap: float = MIN_GAP):
    """(language, score, ambiguous) of every text, as Arrow arrays."""
    langs, scores, unclear = [], [], []
    for lo, hi, data, starts in chunks(column):
        if model is None:
            langs += [UNDETERMINED] * (hi - lo)
            scores.append(np.zeros(hi - lo))
            unclear.append(np.ones(hi - lo, bool))
            continue
        best, score, gap = model.decode(data, starts)
        letter = with_letter(data, starts)
        langs += [model.langs[b] if ok else UNDETERMINED for b, ok in zip(best, letter, strict=True)]
        scores.append(np.where(letter, score, 0))
        unclear.append(~letter | (gap < min_gap))
    flat = [np.concatenate(x) if x else np.zeros(0, t) for x, t in ((scores, float), (unclear, bool))]
    return pa.array(langs, pa.string()), pa.array(flat[0]), pa.array(flat[1])


def inputs(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )


def identify(docs: DataFrame, model: Model | None = None, min_gap: float = MIN_GAP) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous); trains on ``docs`` unless a model is given."""
    small_batches(docs.sparkSession)
    docs = inputs(docs)
    known = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *judged(batch.column("text"), known.value, min_gap)],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    schema = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
    return docs.select("doc_id", (fold() == 0).alias("held_out"), "text").mapInArrow(run, schema)


def with_language(docs: DataFrame, min_gap: float = MIN_GAP) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text has a language that is not in doubt."""
    small_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(train(inputs(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, _, unclear = judged(batch.column("text"), known.value, min_gap)
            keep = [x != UNDETERMINED and not u for x, u in zip(lang.to_pylist(), unclear.to_pylist(), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
