"""Chat formatting with a loss mask aligned to token offsets.

A turn is ``<s>[INST] role [/INST]text</s>``.  Control strings inside roles and texts are
broken by a backslash after their first character, and backslashes are doubled, so the
rendered text reads back to exactly the turns it came from.

The three marks are tokens of their own, added to the vocabulary for the session, so a token
ends where a role or text begins and ends, and no merge reaches over a mark.

A conversation is rendered whole and encoded once; offsets are the running sum of the
tokens' bytes.  The turns under the loss are sorted spans, so the tokens of each are found
by binary search.  What the query reports is read back from the mask: the runs of masked
tokens, whole, as spans of the rendered text.

Rows arrive sorted by conversation and turn, and a task holds one conversation's rendered
text at a time.  Past ``SEGMENT`` characters it is encoded in stretches that end with a mark;
no merge crosses a mark, so the ids are those of the whole text, and a conversation of any
length needs bounded memory beside its longest turn.

The vocabulary is one of byte-level tokens with ranks, so tokens cover the text.  Its regular
expression engine fails on very long runs of white space, so a text with one is split there
as the expression would split it.

Defined results: a null text or role is empty; turns of equal number are ordered by role
and text, a null turn comes first; rows of null ``conv_id`` are one conversation; repeated
rows are turns like others.  An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.queries import query
from clickloom.llm.shared import small_batches, table

# The marks of a turn.
START, MIDDLE, END = "<s>[INST] ", " [/INST]", "</s>"
CONTROL = re.compile(r"<s>|</s>|\[INST\]|\[/INST\]")
TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\](.*?)</s>", re.DOTALL)
ESCAPED = re.compile(r"\\(\\?)")
MARKS = re.compile("(%s)" % "|".join(map(re.escape, (START, MIDDLE, END))))
LOSS_ROLE = "assistant"
LONG_RUN = 1 << 15
WHITE_RUN = re.compile("[^\\S\x1c-\x1f]{%d,}" % LONG_RUN)
SEGMENT = 1 << 20
PROBE = "</s>[INST] ok [/INST]"


def default_tokenizer() -> tuple[str, str]:
    """A file of tokens and ranks, and the expression that splits text into words."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def n_bytes(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


def render(turns: list[tuple[str, str]], loss_role: str = LOSS_ROLE) -> tuple[str, np.ndarray]:
    """The rendered text and the (start, stop) in UTF-8 bytes of every text under the loss, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + MIDDLE, escape(text)
        if role == loss_role:
            spans.append((at + n_bytes(head), at + n_bytes(head) + n_bytes(body)))
        parts += (head, body, END)
        at += n_bytes(head) + n_bytes(body) + len(END)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def turns_of(rendered: str) -> list[tuple[str, str]]:
    """The turns a rendered text was made from."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(rendered)]


class Encoder:
    """A vocabulary of byte-level tokens with the marks as tokens of their own."""

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ranks = ranks
        first = max(ranks.values()) + 2  # the id after the ranks is kept free for an end of text
        self.marks = {mark: first + i for i, mark in enumerate((START, MIDDLE, END))}
        self.tokens = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.marks)
        self.sizes = np.zeros(first + 3, np.int64)
        self.sizes[list(ranks.values())] = [len(token) for token in ranks]
        self.sizes[first:] = [len(mark) for mark in self.marks]

    @cached_property
    def whole(self):
        """The same tokens without a split into words."""
        import tiktoken

        return tiktoken.Encoding("run", pat_str="(?s:.+)", mergeable_ranks=self.ranks, special_tokens={})

    def ids(self, rendered: str) -> np.ndarray:
        if len(rendered) < LONG_RUN or not WHITE_RUN.search(rendered):
            return self.tokens.encode_to_numpy(rendered, allowed_special="all")
        parts = [[self.marks[p]] if p in self.marks else self.plain(p) for p in MARKS.split(rendered)]
        return np.fromiter(chain.from_iterable(parts), np.uint32)

    def plain(self, text: str) -> list[int]:
        """Ids of a text without marks; a run of white space leaves its last character to what follows it."""
        out, at = [], 0
        for run in WHITE_RUN.finditer(text):
            stop = run.end() - (run.end() < len(text))
            out += self.tokens.encode_ordinary(text[at : run.start()])
            out += self.whole.encode_ordinary(text[run.start() : stop])
            at = stop
        return out + self.tokens.encode_ordinary(text[at:])

    def spans(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, stop) in bytes of every token; one may be a piece of a character."""
        stop = np.cumsum(self.sizes[ids])
        return stop - self.sizes[ids], stop


def loss_mask(start: np.ndarray, stop: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Whether a token lies in one of the sorted spans; spans end where tokens end."""
    spans = spans[spans[:, 1] > spans[:, 0]]
    low = np.searchsorted(stop, spans[:, 0], "right")
    high = np.searchsorted(start, spans[:, 1], "left")
    if (start[low] != spans[:, 0]).any() or (stop[high - 1] != spans[:, 1]).any():
        raise ValueError("a token reaches over a mark")
    change = np.zeros(len(start) + 1, np.int64)
    change[low] += 1
    change[high] -= 1
    return np.cumsum(change[:-1]) > 0


def masked_runs(mask: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    """(start, stop) in bytes of every run of masked tokens."""
    edge = np.flatnonzero(np.diff(np.r_[False, mask, False]))
    return list(zip(start[edge[::2]].tolist(), stop[edge[1::2] - 1].tolist(), strict=True))


class Conversation:
    """What one conversation's output adds up to, stretch by stretch."""

    def __init__(self, conv_id, encoder: Encoder, with_tokens: bool) -> None:
        self.conv_id, self.encoder, self.with_tokens = conv_id, encoder, with_tokens
        self.held, self.size = [], 0
        self.turns = self.loss_chars = self.chars = 0
        self.turns_digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()
        self.text, self.ids, self.mask = [], [], []

    def add(self, role: str, text: str) -> None:
        self.held.append((role, text))
        self.size += len(text)
        if self.size > SEGMENT:
            self.flush()

    def flush(self) -> None:
        rendered, spans = render(self.held)
        self.held, self.size = [], 0
        ids = self.encoder.ids(rendered)
        start, stop = self.encoder.spans(ids)
        mask = loss_mask(start, stop, spans)
        for role, text in turns_of(rendered):
            self.turns_digest.update(f"{role}\n{text}\n".encode())
            self.turns += 1
        data = rendered.encode()
        for a, b in masked_runs(mask, start, stop):
            text = unescape(data[a:b].decode())
            self.loss_chars += len(text)
            self.loss_digest.update(text.encode())
        self.chars += len(rendered)
        if self.with_tokens:
            self.text.append(rendered)
            self.ids.append(ids.tolist())
            self.mask.append(mask.tolist())

    def row(self) -> tuple:
        if self.held:
            self.flush()
        out = (self.conv_id, self.turns, self.turns_digest.hexdigest(), self.loss_chars, self.loss_digest.hexdigest(), self.chars)
        if self.with_tokens:
            out += ("".join(self.text), list(chain(*self.ids)), list(chain(*self.mask)))
        return out


FIELDS = (
    ("conv_id", "long", pa.int64()),
    ("n_turns", "long", pa.int64()),
    ("turns_sha256", "string", pa.string()),
    ("loss_chars", "long", pa.int64()),
    ("loss_sha256", "string", pa.string()),
    ("formatted_chars", "long", pa.int64()),
    ("formatted", "string", pa.string()),
    ("input_ids", "array<int>", pa.list_(pa.int32())),
    ("loss_mask", "array<boolean>", pa.list_(pa.bool_())),
)


def format_chats(conversations: DataFrame, tokenizer: tuple[str, str] | None = None, with_tokens: bool = True) -> DataFrame:
    """One row per conversation: digests of what reads back from the output and, on demand, text, ids and mask."""
    small_batches(conversations.sparkSession)
    vocabulary = tokenizer or default_tokenizer()
    fields = FIELDS if with_tokens else FIELDS[:6]
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def out(found: list[Conversation]) -> pa.RecordBatch:
        columns = list(zip(*[c.row() for c in found], strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, (_, _, t) in zip(columns, fields, strict=True)], names=[f[0] for f in fields]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*vocabulary)
        now, done = None, []
        for batch in batches:
            for conv_id, _, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done.append(now)
                    if len(done) >= 64:
                        yield out(done)
                        done = []
                    now = Conversation(conv_id, encoder, with_tokens)
                now.add(role, text)
        if now is not None:
            yield out([*done, now])

    return rows.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind, _ in fields))


@query("op7_chat_formatting")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(LOSS_ROLE).alias("role"), F.lit(PROBE).alias("text"),
    )
    return format_chats(chats.unionByName(probe), with_tokens=False)
