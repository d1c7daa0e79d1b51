"""Packing: exact round trip, binary lengths, and the tokenizer's own ids."""

import struct
import zlib

import pytest

from shelfwise.llm.packing import StretchTokenizer, pack, piece_lengths
from shelfwise.llm.queries import tokenizer_file

TEXTS = ["The river, the RIVER!! ran\nover.", None, "", "  ", "a\tb\r\nc  d e", "İSTANBUL ΣΑΣ it's 42%", "<|endoftext|> x<|startoftext|>y <|STARTOFTEXT|>",
         "é é ² ½. x̀. 한국어, ﬁ…", "word " * 9000, "wordwithoutend" * 800]


def test_piece_lengths():
    assert piece_lengths(4096 * 2 + 13) == [4096, 4096, 8, 4, 1]
    for n in range(0, 300):
        lengths = piece_lengths(n, 16)
        assert sum(lengths) == n and all(x <= 16 and x & (x - 1) == 0 for x in lengths)


def test_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_file())
    cut = StretchTokenizer(tokenizer_file())
    for text in TEXTS:
        want = whole.encode(text or "", add_special_tokens=False).ids
        assert list(cut.encode([text or ""]))[0] == struct.pack(f"<{len(want)}I", *want), text


def test_every_letter_before_punctuation():
    """Lower case and normal forms of some letters end with a mark that joins what follows."""
    from tokenizers import Tokenizer

    whole, cut = Tokenizer.from_file(tokenizer_file()), StretchTokenizer(tokenizer_file())
    texts = [f"a{chr(c)}?." for c in range(0x30, 0x110000) if chr(c).isalnum()] + ["BU KEL\u0130MELER\u0130, \u0130STANBUL\u0130.", "\u09dc, \u09df."]
    for at in range(0, len(texts), 4000):
        some = texts[at:at + 4000]
        want = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in whole.encode_batch(some, add_special_tokens=False)]
        assert [t for t, w, g in zip(some, want, cut.encode(some)) if w != g] == []


def test_round_trip(spark, make_docs):
    from tokenizers import Tokenizer

    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "s"), (None, "null id", "s")]
    docs = make_docs([(*r, 7) for r in rows], ", length int").repartition(3)
    got = pack(docs, tokenizer_file()).collect()
    assert len({r.sequence_id for r in got}) == len(got)
    assert all(r.length == 2 ** r.bucket <= 4096 and r.offset == 0 and len(r.ids) == 4 * r.length for r in got)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    tokenizer = Tokenizer.from_file(tokenizer_file())
    for doc_id, text, _ in rows:
        pieces = sorted((r for r in got if r.doc_id == doc_id), key=lambda r: r.start)
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        once = pieces[::2] if doc_id == 3 else pieces
        assert b"".join(p.ids for p in once) == struct.pack(f"<{len(want)}I", *want)
        assert {p.doc_tokens for p in pieces} == {len(want)}
    assert pack(docs.limit(0), tokenizer_file()).count() == 0


def test_longest_must_be_a_power(make_docs):
    with pytest.raises(ValueError):
        pack(make_docs([(1, "x", "s")]), tokenizer_file(), longest=100)
