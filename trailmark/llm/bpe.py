"""BPE encoding and decoding of whole texts.

The vocabulary is a ``tokenizers`` JSON file of the word-end kind (NFC,
white space folded, lower case, split into words, byte symbols, a suffix on
the last symbol of a word); its path is a parameter and is opened on the
executors.

Merging follows the contiguous rank array: a short word holds the parts
between its boundaries in one array and the rank of every adjacent pair in
another; the smallest rank is found by a scan, its boundary is deleted and
the two neighbouring ranks are looked up again.  The unknown words of many
texts are rows of such arrays and go through these steps together.  Words
longer than ``SHORT_WORD`` symbols use the same merge order through a heap,
so that a text without any space costs n log n, not n squared.

Texts are narrow work: one pass, no shuffle.  Texts are taken together up
to ``BYTES_AT_ONCE`` bytes (a longer one alone), and each distinct
stretch between spaces is looked up once.  Stretches of plain letters, with
or without a mark behind them, are folded and cut by Arrow all together,
only the others by Python one by one.  Each Python worker keeps the
encodings of the words it has met last, about twice ``CACHE_WORDS`` at most.

Defined cases: a null text is an empty one; an empty text has no ids and
decodes to the empty string; repeated rows each give a row; other columns
are not carried.
"""

from __future__ import annotations

import array
import heapq
import json
import os
import re
import struct
import sys
import unicodedata
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import held, map_texts, slices

SHORT_WORD = 64
CACHE_WORDS = 200_000
CACHE_CHARS = 64
#: bytes of texts and words that are handled together
BYTES_AT_ONCE, WORDS_AT_ONCE = 1 << 21, 1 << 13

# The Unicode white space that the vocabulary file's \s stands for
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
# each of these is a word of its own behind letters
_MARKS = ",.;:!?"
_ENDS = frozenset(_MARKS)
# Letters that NFC leaves alone, whichever of them follow, and whose lower case is one character: those of
# Latin-1, Latin Extended-A without the dotted I, and basic Cyrillic.  Plain chunks are some of them with at
# most one mark behind.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u0400-\u045f"
_PLAIN, _INSIDE_PLAIN = f"^[{_LETTERS}]+[{_MARKS}]?$", re.compile(f"[{_LETTERS}]*[{_MARKS}]?")
_BITS, _LOW = 16, (1 << 16) - 1  # ids fit in so many bits
_NO_RANK = 1 << 40
_SLOTS, _SLOT_SHIFT, _HASHED = 6, 31, (1 << 48) - 1  # 2^17 rows
assert sys.byteorder == "little"  # array.array below reads ids as they are packed


def default_tokenizer() -> str:
    """Path of the word-end vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1
    characters for themselves, the others moved up past 255 in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


def _folded(text: str) -> str:
    """NFC in lower case, character by character: no final sigma."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def _slots(merges: dict[int, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """The merges as a hash table of rows of ``_SLOTS`` places: multiplier,
    keys and ranks.  Multipliers are tried until no row overflows."""
    keys, ranks = (np.fromiter(x, dtype=np.int64, count=len(merges)) for x in (merges.keys(), merges.values()))
    for seed in count():
        spread = int(np.random.default_rng(seed).integers(1 << 30, 1 << 31)) | 1
        row = (keys * spread & _HASHED) >> _SLOT_SHIFT
        order = np.argsort(row, kind="stable")
        place = np.arange(len(row)) - np.searchsorted(row[order], row[order])
        if not len(place) or place.max() < _SLOTS:
            break
    slot_keys = np.full((1 << 17, _SLOTS), -1, dtype=np.int64)
    slot_ranks = np.full((1 << 17, _SLOTS), _NO_RANK, dtype=np.int64)
    slot_keys[row[order], place], slot_ranks[row[order], place] = keys[order], ranks[order]
    return spread, slot_keys, slot_ranks


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or spec.get("decoder"):
            raise ValueError(f"{path}: not a word-end BPE vocabulary")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        vocab: dict[str, int] = model["vocab"]
        if max(vocab.values()) > _LOW:
            raise ValueError(f"{path}: more than {_LOW + 1} ids")
        pairs = (p if isinstance(p, list) else p.split(" ") for p in model["merges"])
        # (left id, right id) -> rank, with the merged id in the low bits
        self.merges = {vocab[a] << _BITS | vocab[b]: rank << _BITS | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        self.spread, self.slot_keys, self.slot_ranks = _slots(self.merges)
        symbols = byte_symbols()
        self.byte_ids = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.last_ids = np.array([vocab[s + model["end_of_word_suffix"]] for s in symbols], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (vocab | self.special).items()}
        self.words_of = regex.compile(split).findall
        self.opening = os.path.commonprefix([*self.special])
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        # no chunk goes the plain way if a special string could be part of one
        self.plain = "^$" if any(map(_INSIDE_PLAIN.fullmatch, self.special)) else _PLAIN
        self.special_ids = {t: struct.pack("<I", i) for t, i in self.special.items()}
        # special strings stay in the younger cache
        self.young: dict[str, bytes] = {**self.special_ids}
        self.old: dict[str, bytes] = {}

    # -- merging -----------------------------------------------------------
    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, with the id of the merged part in the low bits."""
        key = left << _BITS | right
        slots = (key * self.spread & _HASHED) >> _SLOT_SHIFT
        hit = self.slot_keys[slots] == key[:, None]
        return np.where(hit.any(axis=1), self.slot_ranks[slots, hit.argmax(axis=1)], _NO_RANK)

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words of at most ``SHORT_WORD`` bytes.  Each word is
        a row: the ids of its parts and, for the boundary behind each part,
        the rank of the two parts around it.  In every round all rows that
        still have a rank delete the boundary of their least one."""
        sizes = np.fromiter(map(len, words), dtype=np.int64)
        width, row = int(sizes.max()), np.repeat(np.arange(len(words)), sizes)
        column = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids = np.zeros((len(words), width + 1), dtype=np.int64)
        symbols = np.frombuffer(b"".join(words), dtype=np.uint8)
        ids[row, column] = self.byte_ids[symbols]
        last = np.cumsum(sizes) - 1
        ids[np.arange(len(words)), sizes - 1] = self.last_ids[symbols[last]]
        ranks = np.full((len(words), width + 1), _NO_RANK, dtype=np.int64)
        inner = np.nonzero(column < np.repeat(sizes, sizes) - 1)[0]
        ranks[row[inner], column[inner]] = self.rank_of(ids[row[inner], column[inner]], ids[row[inner], column[inner] + 1])
        done, parts, own = np.zeros_like(ids), sizes.copy(), np.arange(len(words))
        at = np.arange(width)
        while len(own):
            i = ranks.argmin(axis=1)
            least = ranks[np.arange(len(own)), i]
            more = least != _NO_RANK
            if not more.all():
                done[own[~more]] = ids[~more]
                own, ids, ranks, i, least = own[more], ids[more], ranks[more], i[more], least[more]
                if not len(own):
                    break
            here, every = least & _LOW, np.arange(len(own))
            ids[:, :-1] = np.where(at > i[:, None], ids[:, 1:], ids[:, :-1])
            ranks[:, :-1] = np.where(at >= i[:, None], ranks[:, 1:], ranks[:, :-1])
            ids[every, i] = here
            parts[own] -= 1
            behind = np.nonzero(i < parts[own] - 1)[0]
            ranks[behind, i[behind]] = self.rank_of(here[behind], ids[behind, i[behind] + 1])
            before = np.nonzero(i > 0)[0]
            ranks[before, i[before] - 1] = self.rank_of(ids[before, i[before] - 1], here[before])
        packed = done[np.arange(width + 1) < parts[:, None]].astype("<u4").tobytes()
        ends = (4 * np.cumsum(parts)).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def merge_long(self, word: bytes) -> bytes:
        """The same merge order for a long word: smallest rank first, then
        leftmost, from a heap over a linked list of parts."""
        n, merges = len(word), self.merges
        ids = self.byte_ids[np.frombuffer(word, dtype=np.uint8)].tolist()
        ids[-1] = int(self.last_ids[word[-1]])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (r := merges.get(ids[i] << _BITS | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = rank & _LOW, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := merges.get(ids[a] << _BITS | ids[b])) is not None:
                    heapq.heappush(heap, (r, a, ids[a], ids[b]))
        return array.array("I", [i for i in ids if i >= 0]).tobytes()

    # -- texts -------------------------------------------------------------
    def parts_of(self, chunk: str) -> list[str]:
        """Words and special strings of a stretch of text without ASCII white space."""
        if not chunk.isascii() and len(pieces := _SPACE.split(chunk)) > 1:
            return [w for piece in pieces for w in self.parts_of(piece)]
        if self.opening in chunk:
            return [w for part in self.split_special(chunk) if part
                    for w in ([part] if part in self.special else self.words_of(_folded(part)))]
        folded = _folded(chunk)
        if folded.isalpha():
            return [folded]
        if folded[:-1].isalpha() and folded[-1] in _ENDS:
            return [folded[:-1], folded[-1]]
        return self.words_of(folded)

    def word_ids(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word.  Unknown ones are merged together; what
        was last in use in the older cache moves up to the younger."""
        if len(self.young) >= CACHE_WORDS:
            self.young, self.old = {**self.special_ids}, self.young
        found = list(map(self.young.get, words))
        lost = [w for w, ids in zip(words, found) if ids is None]
        fresh = {w: ids for w, ids in zip(lost, map(self.old.get, lost)) if ids is not None}
        unknown = sorted({w for w in lost if w not in fresh}, key=len)
        for start in range(0, len(unknown), WORDS_AT_ONCE):
            some = unknown[start:start + WORDS_AT_ONCE]
            coded = [w.encode() for w in some]
            if max(map(len, coded)) <= SHORT_WORD:
                fresh.update(zip(some, self.merge_short(coded)))
            else:
                fresh.update((w, self.merge_long(b) if len(b) > SHORT_WORD else self.merge_short([b])[0])
                             for w, b in zip(some, coded))
        self.young.update((w, ids) for w, ids in fresh.items() if len(w) <= CACHE_CHARS)
        return [fresh[w] if ids is None else ids for w, ids in zip(words, found)]

    def chunk_ids(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Packed ids of distinct chunks: an array of them, and the place of
        each chunk in it.  Plain words, with or without one mark behind them,
        are folded and cut by Arrow all at once; the others are taken apart
        one by one."""
        is_plain = pc.match_substring_regex(chunks, self.plain)
        folded = pc.utf8_lower(chunks.filter(is_plain))
        stems = pc.ascii_rtrim(folded, _MARKS).dictionary_encode()
        marks = pc.index_in(pc.utf8_slice_codeunits(folded, -1), pa.array([*_MARKS], folded.type))
        words = stems.dictionary.to_numpy(zero_copy_only=False).tolist()
        parts = [self.parts_of(c) for c in chunks.filter(pc.invert(is_plain)).to_numpy(zero_copy_only=False)]
        ids = self.word_ids([*_MARKS, *words, *chain.from_iterable(parts)])
        ends = np.cumsum([len(_MARKS), len(words), *map(len, parts)]).tolist()
        mark_ids, stem_ids = (pa.array(some, pa.large_binary()) for some in (ids[:ends[0]], ids[ends[0]:ends[1]]))
        plain_ids = pc.binary_join_element_wise(
            stem_ids.take(stems.indices), pc.fill_null(mark_ids.take(marks), b""), pa.scalar(b"", pa.large_binary()))
        other_ids = pa.array([b"".join(ids[a:b]) for a, b in zip(ends[1:], ends[2:])], pa.large_binary())
        plain = is_plain.to_numpy(zero_copy_only=False)
        place = np.where(plain, np.cumsum(plain), len(plain_ids) + np.cumsum(~plain)).astype(np.int32) - 1
        return pa.concat_arrays([plain_ids, other_ids]), place

    def encode_many(self, texts: pa.StringArray) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        split = pc.ascii_split_whitespace(texts)
        chunks = split.flatten().dictionary_encode()
        ids, place = self.chunk_ids(chunks.dictionary)
        ids = ids.take(pa.array(place[chunks.indices.to_numpy()]))
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset:ids.offset + len(ids) + 1]
        counts = np.cumsum(np.append(0, pc.list_value_length(split).to_numpy()))
        data, at = ids.buffers()[2], ends[counts].tolist()
        return [data[a:b].to_pybytes() if b > a else b"" for a, b in zip(at, at[1:])]

    def encode_bytes(self, text: str) -> bytes:
        return self.encode_many(pa.array([text]))[0]

    def encode(self, text: str) -> list[int]:
        return array.array("I", self.encode_bytes(text)).tolist()

    def round_trips(self, texts: pa.StringArray) -> list[tuple[bytes, str]]:
        """Ids of whole texts and the decoding of those ids."""
        return [(ids, self.decode(array.array("I", ids))) for ids in self.encode_many(texts)]

    def decode(self, ids) -> str:
        """The tokens of the ids joined by spaces, as a file without a
        decoder prescribes; unknown ids are left out."""
        names = self.names
        try:
            return " ".join([names[i] for i in ids])
        except KeyError:
            return " ".join([names[i] for i in ids if i in names])


def word_bpe(path: str) -> WordBpe:
    """The encoder of ``path``, one per Python worker until it runs another operator."""
    return held(("word_bpe", path), lambda: WordBpe(path))


def encode_decode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  tokenizer: str | None = None) -> DataFrame:
    """Encode every text and decode its ids again: columns ``id_col``,
    ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded``."""
    path = tokenizer or default_tokenizer()
    return map_texts(docs, id_col, text_col, lambda: word_bpe(path).round_trips,
                     [("ids", pa.binary(), "binary"), ("decoded", pa.string(), "string")], together=BYTES_AT_ONCE)


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           tokenizer: str | None = None) -> DataFrame:
    """Columns ``id_col`` and ``ids`` (array of int)."""
    path = tokenizer or default_tokenizer()
    return map_texts(docs, id_col, text_col,
                     lambda: lambda texts, e=word_bpe(path).encode_many: [(np.frombuffer(i, "<i4"),) for i in e(texts)],
                     [("ids", pa.list_(pa.int32()), "array<int>")], together=BYTES_AT_ONCE)


def decode(encoded: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids",
           tokenizer: str | None = None) -> DataFrame:
    """Columns ``id_col`` and ``text``; null ids decode to the empty string."""
    path = tokenizer or default_tokenizer()
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches):
        tokenizer = word_bpe(path)
        for batch in slices(batches):
            texts = [tokenizer.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return rows.mapInArrow(run, f"`{id_col}` {rows.schema['id'].dataType.simpleString()}, text string")
