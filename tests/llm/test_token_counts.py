"""Token counts against the sentencepiece library."""

import random

import pytest
import sentencepiece

from trailmark.llm import token_counts

PIECES = list("abcdehilnorst") + [
    "▁", " ", "  ", "\n", "\t", "<s>", "</s>", "<unk>", "<0x0A>", "é", "中", "😀", "\x00", "　", "̇", "ing",
    "tion", "==", "--", "....", "0", "1", " ", "ſ", "ß", "Ж", "и", "🏳️‍🌈"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=token_counts.default_model())


@pytest.fixture(scope="module")
def ranks():
    return token_counts.pieces_of(token_counts.default_model())


def _texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 30))) for _ in range(n)]


def test_random_texts(library, ranks):
    machine = token_counts.Transducer(ranks)
    for text in _texts(8000, 1) + ["a" * 90000, "abc" * 30000, " " * 70000, "=-" * 40000, " x" * 60000]:
        assert machine.count(text) == len(library.encode(text)), text[:60]


@pytest.mark.parametrize("chunk", [1, 2, 5, 17])
def test_chunk_maps_compose(library, ranks, chunk, monkeypatch):
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    machine = token_counts.Transducer(ranks)
    for text in _texts(1500, chunk):
        assert machine.count(text) == len(library.encode(text)), text


@pytest.mark.parametrize("mark, back", [(1, 0), (3, 2), (1024, 256)])
def test_scan_of_chunks(library, ranks, mark, back, monkeypatch):
    """Every prefix of the scan, also for texts without any space and where
    the characters in front give another state than the real one."""
    for name, value in (("CHUNK", 7), ("MARK", mark), ("LOOK_BACK", back)):
        monkeypatch.setattr(token_counts, name, value)
    machine = token_counts.Transducer(ranks)
    rng = random.Random(back)
    solid = ["".join(rng.choices("aeinrst=-0é中", k=rng.randint(8, 90))) for _ in range(300)]
    for text in solid + ["=" * 60, "a" * 50, "   " * 20, "in   " * 12] + _texts(300, mark):
        normal = token_counts.SPACE + text.replace(" ", token_counts.SPACE)
        ends = [min(at + 7, len(normal)) for at in range(0, len(normal), 7)]
        wanted = [len(library.encode(normal[1:end])) for end in ends]
        if text:
            assert machine.counts(normal)[1:] == wanted[1:], text


def test_a_map_is_extended_by_the_state_it_lacks(ranks, monkeypatch):
    monkeypatch.setattr(token_counts, "LOOK_BACK", 0)
    machine = token_counts.Transducer(ranks)
    text = "internationalization" * 3
    plain = machine.chunk_map(text, 25, 60)
    assert [*plain.known] == [token_counts.START]
    state, before = machine.follow(token_counts.START, text[:25])
    leave, behind = plain(state)
    assert len(plain.known) == 2
    assert (leave, before + behind) == machine.follow(token_counts.START, text)


def test_few_states(library, ranks, monkeypatch):
    for name, value in (("STATES", 40), ("CACHE_PAIRS", 50), ("CACHE_UNITS", 10)):
        monkeypatch.setattr(token_counts, name, value)
    machine = token_counts.Transducer(ranks)
    for text in _texts(1500, 3):
        assert machine.count(text) == len(library.encode(text)), text
    assert len(machine.states) <= 60


def test_operator(docs_of, library):
    texts = {1: "Hello  world", 2: None, 3: "", 4: "é" * 3000, 5: "one two " * 30000}
    got = {r.doc_id: r for r in token_counts.count_tokens(docs_of([*texts.items(), (1, texts[1])])).collect()}
    for i, text in texts.items():
        n = len(library.encode(text or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 4096)
    assert token_counts.count_tokens(docs_of([])).count() == 0
    assert token_counts.count_tokens(docs_of([(None, "a"), (1, "a"), (1, "a")])).count() == 3
