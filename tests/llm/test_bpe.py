"""BPE encoding and decoding against the tokenizers library."""

import json
import random
import re
import struct

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from trailmark.llm import bpe

PIECES = ["a", "B", "'s", "'", "Σ", "İ", "é", "é", "1", "½", "Ⅷ", "　", "\x1c", "\x85", " ", "\n",
          "<|endoftext|>", "<|startoftext|>", "<|", "😀", "中", "̇", "﻿", "​", "\x00", "the", "ing",
          "ǅ", "ß", "K", "_", "-", "!", "²", " ", "᠎", "ﬁ"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.default_tokenizer())
    t.no_truncation()
    t.no_padding()
    return t


def test_random_texts(library):
    coder, rng = bpe.WordBpe(bpe.default_tokenizer()), random.Random(1)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(4000)]
    for text in texts + ["a" * 3000, "ha" * 900 + "!" * 300, "x" * 64, "x" * 65, "th" * 33]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids, text
        assert coder.round_trips(pa.array([text]))[0][1] == library.decode(ids, skip_special_tokens=False), text


def test_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    coder = bpe.WordBpe(bpe.default_tokenizer())
    text = " ".join(f"word{i % 17} other{i % 7}," for i in range(200))
    assert coder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_texts_together(library, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcdefgéß'.,!1", k=rng.randint(1, 30))) for _ in range(rng.randint(0, 40)))
             for _ in range(300)] + ["", "Σ", "a\x1cb", "a\xa0b's\u3000c\u2003", "The, end. <|endoftext|>now", "x" * 70 + " y"]
    want = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    coder = bpe.WordBpe(bpe.default_tokenizer())
    assert coder.encode_many(pa.array(texts)) == want == coder.encode_many(pa.array(texts))
    for name, value in (("WORDS_AT_ONCE", 3), ("CACHE_WORDS", 20), ("SHORT_WORD", 6)):
        monkeypatch.setattr(bpe, name, value)
        assert bpe.WordBpe(bpe.default_tokenizer()).encode_many(pa.array(texts)) == want


def test_plain_words_are_not_taken_apart_one_by_one(library, monkeypatch):
    texts = ["The End. Où, été ÉTÉ! Straße; Łódź: Привет? plain Words", "don't x2 (a) Σ e\u0301a İz <|endoftext|>The a.b a,, ."]
    coder, apart, one = bpe.WordBpe(bpe.default_tokenizer()), [], bpe.WordBpe.parts_of
    monkeypatch.setattr(bpe.WordBpe, "parts_of", lambda self, chunk: apart.append(chunk) or one(self, chunk))
    want = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert coder.encode_many(pa.array(texts)) == want
    assert {*apart} == {*texts[1].split()}


def test_every_plain_letter(library):
    letters = [chr(c) for c in range(0x41, 0x460) if re.fullmatch(f"[{bpe._LETTERS}]", chr(c))]
    assert len(letters) > 250
    texts = [*letters, *(c + d + m for c in letters for d in "aZ\u00e9\u0436" for m in ("", ",", "\u0301"))]
    coder = bpe.WordBpe(bpe.default_tokenizer())
    want = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert coder.encode_many(pa.array(texts)) == want


def test_special_strings_of_letters(library, tmp_path):
    with open(bpe.default_tokenizer(), encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"][0]["content"] = "Pad"
    path = tmp_path / "pad.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    coder = bpe.WordBpe(str(path))
    assert coder.encode("Pad a Padded pad") == [i for t in ("Pad", "a", "Pad", "ded", "pad") for i in (
        [coder.special["Pad"]] if t == "Pad" else library.encode(t, add_special_tokens=False).ids)]


def test_operator(docs_of, library):
    texts = {1: "Hello, world", 2: None, 3: "", 4: "Hello, world", 5: "long word " * 3000}
    got = {r.doc_id: r for r in bpe.encode_decode(docs_of([*texts.items(), (1, "Hello, world")])).collect()}
    for i, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert bytes(got[i].ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode_decode(docs_of([(1, "a"), (1, "a"), (None, "b")])).count() == 3
    assert bpe.encode_decode(docs_of([])).count() == 0


def test_arrays(docs_of, library):
    encoded = bpe.encode(docs_of([(1, "An odd word"), (2, None)]))
    assert {r.doc_id: r.ids for r in encoded.collect()} == {
        1: library.encode("An odd word", add_special_tokens=False).ids, 2: []}
    assert {r.doc_id: r.text for r in bpe.decode(encoded).collect()} == {1: "an</w> odd</w> word</w>", 2: ""}


def test_other_kinds_are_refused():
    import public_tokenizers
    with pytest.raises(ValueError):
        bpe.WordBpe(public_tokenizers.path("byte_bpe_50k.json"))
