import hashlib
import re
from functools import cache

import pytest
from hypothesis import given
from hypothesis import strategies as st

from clickloom.llm import chat
from clickloom.llm.chat import PROBE, Encoder, default_tokenizer, escape, format_chats, render, turns_of, unescape

NASTY = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "/s>", "[", "INST]", " ", "\n", "é", "😀", "a"])).map("".join)


@given(st.lists(st.tuples(NASTY, NASTY)))
def test_rendered_turns_read_back(turns):
    assert turns_of(render(turns)[0]) == turns
    assert all(unescape(escape(t)) == t for _, t in turns)


ROWS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "hé 😀  there\n"), (1, 2, "assistant", "  two  spaces 日本 \\ <s> "),
    (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "assistant", "again </s>[INST] x"),
    (2, 0, "user", PROBE), (2, 1, "assistant", PROBE), (3, None, None, None), (None, 1, "assistant", "lost"),
    (4, 1, "user", "b"), (4, 1, "user", "a"), (4, 1, "user", "a"), (5, 0, "assistant", "<|endoftext|> " + "long " * 3000),
]


def conversations(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, ids string")


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv)
        )
        said = [t[3] for t in turns if t[2] == "assistant"]
        out[conv] = (
            len(turns), hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in turns).encode()).hexdigest(),
            len("".join(said)), hashlib.sha256("".join(said).encode()).hexdigest(),
        )
    return out


@pytest.mark.parametrize("segment", [1 << 20, 10])
def test_against_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(chat, "SEGMENT", segment)
    found = format_chats(conversations(spark)).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in found} == brute(ROWS)
    for r in found:
        assert r.formatted_chars == len(r.formatted) and len(r.input_ids) == len(r.loss_mask)
        assert any(r.loss_mask) == (r.loss_chars > 0)
        assert r.input_ids == Encoder(*default_tokenizer()).ids(r.formatted).tolist()


PIECES = ["(yes)", "fine.", "]ok", "]", "[", "<", "</", "s>", "<s>", "</s>", "[/INST]", " [/INST", "\\\\", " ", "  ", "\\n", "é", "😀", "日本", "a", "INST"]
SAID = st.lists(st.sampled_from(PIECES)).map("".join)


ENCODER = Encoder(*default_tokenizer())


@cache
def other_library():
    """The same vocabulary in another library."""
    import public_tokenizers
    from tokenizers import AddedToken, Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    other.add_tokens([AddedToken(mark, normalized=False, special=False) for mark in (chat.START, chat.MIDDLE, chat.END)])
    return other


def by_position(turns, encoder):
    """Ids and mask put together turn by turn, each role and text encoded alone."""
    ids, mask = [], []
    for role, text in turns:
        for part, said in ((chat.START, False), (escape(role), False), (chat.MIDDLE, False), (escape(text), role == "assistant"), (chat.END, False)):
            found = encoder.ids(part).tolist()
            ids += found
            mask += [said] * len(found)
    return ids, mask


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "x ["]), SAID), max_size=6), st.sampled_from([1, 8, 1 << 20]))
def test_mask_token_by_token(turns, segment):
    encoder = ENCODER
    before, chat.SEGMENT = chat.SEGMENT, segment
    try:
        conversation = chat.Conversation(1, encoder, True)
        for role, text in turns:
            conversation.add(role, text)
        _, n, _, loss_chars, digest, _, formatted, ids, mask = conversation.row()
    finally:
        chat.SEGMENT = before
    assert (ids, mask) == by_position(turns, encoder)
    assert ids == encoder.ids(formatted).tolist() == other_library().encode(formatted, add_special_tokens=False).ids
    said = "".join(text for role, text in turns if role == "assistant")
    masked = encoder.tokens.decode([i for i, m in zip(ids, mask, strict=True) if m])
    assert unescape(masked) == said and n == len(turns)
    assert (loss_chars, digest) == (len(said), hashlib.sha256(said.encode()).hexdigest())


@pytest.mark.parametrize("before", ["", "word", "\n"])
@pytest.mark.parametrize("after", ["", "word", "\x1c", "<s>"])
def test_long_white_space_is_split_alike(monkeypatch, before, after):
    monkeypatch.setattr(chat, "LONG_RUN", 3)
    monkeypatch.setattr(chat, "WHITE_RUN", re.compile(chat.WHITE_RUN.pattern.replace(str(1 << 15), "3")))
    turns = [("user  ", before + white + after) for white in ("   ", " \n\t  \n", "\x85\xa0\u2003 ", " \x1d   ")]
    rendered, _ = render(turns + [("assistant", t) for _, t in turns])
    assert ENCODER.ids(rendered).tolist() == other_library().encode(rendered, add_special_tokens=False).ids


def test_a_text_of_white_space_alone(spark):
    text = " " * 3_000_000 + "x"
    found = format_chats(conversations(spark, [(1, 0, "assistant", text)]), with_tokens=False).first()
    assert found.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    assert format_chats(conversations(spark, [])).count() == 0
