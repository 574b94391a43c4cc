"""Conversation repair against plain versions."""

import hashlib
import heapq
import itertools
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from trailmark.llm import conversations as cv

LEGAL = re.compile("(s?(ua)+)?")
KINDS = "suaoSUAO-"


def _options(kind):
    yield "D", "", 3
    if kind != "-":
        stays = int(kind.isupper())
        yield "R", "u", 2 + stays
        yield "R", "a", 2 + stays
        if kind.lower() != "o":
            yield "K", kind.lower(), stays


def _by_enumeration(kinds):
    """Every choice of an edit for each row and of at most two insertions in each gap."""
    inserted = [x for n in range(3) for x in itertools.product("ua", repeat=n)]
    best = None
    for gaps in itertools.product(inserted, repeat=len(kinds) + 1):
        for edits in itertools.product(*(list(_options(k)) for k in kinds)):
            initials, audit, cost = "".join(gaps[0]), "I" * len(gaps[0]), 2 * len(gaps[0])
            for (edit, initial, price), gap in zip(edits, gaps[1:]):
                initials, audit = initials + initial + "".join(gap), audit + edit + "I" * len(gap)
                cost += price + 2 * len(gap)
            if LEGAL.fullmatch(initials) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def _by_search(kinds):
    """Least (cost, audit) first over (rows read, state); states: start, after s, u, a."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, state = heapq.heappop(heap)
        if (at, state) in done:
            continue
        if at == len(kinds) and state in ("", "a"):
            return cost, audit
        done.add((at, state))
        for x in "ua":
            if x in step[state]:
                heapq.heappush(heap, (cost + 2, audit + "I", at, step[state][x]))
        if at < len(kinds):
            for edit, initial, price in _options(kinds[at]):
                if edit == "D":
                    heapq.heappush(heap, (cost + price, audit + edit, at + 1, state))
                elif initial in step[state]:
                    heapq.heappush(heap, (cost + price, audit + edit, at + 1, step[state][initial]))


def test_short_conversations_by_enumeration():
    for n in range(3):
        for kinds in itertools.product(KINDS, repeat=n):
            assert cv.cheapest(cv.parse("".join(kinds))) == _by_enumeration(kinds), kinds


def test_longer_conversations_by_search():
    rng = random.Random(5)
    for _ in range(400):
        kinds = "".join(rng.choice(KINDS if rng.random() < 0.5 else "ua") for _ in range(rng.randrange(60)))
        assert cv.cheapest(cv.parse(kinds)) == _by_search(kinds), kinds
    long_ = "".join(rng.choice("uauaS-") for _ in range(900))
    assert cv.cheapest(cv.parse(long_)) == _by_search(long_)


def test_every_cut_gives_the_same_cell():
    rng = random.Random(6)
    for _ in range(60):
        kinds = "".join(rng.choice(KINDS) for _ in range(rng.randrange(2, 24)))
        for cut in range(1, len(kinds)):
            assert cv.combine([cv.parse(kinds[:cut]), cv.parse(kinds[cut:])]) == cv.parse(kinds)


def _plain(rows):
    """Straight from the rules, one conversation after the other."""
    kept, ids = defaultdict(list), set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        role, text = (" " if x is None else x for x in (role, text))
        code = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        kept[conv] += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    out = Counter()
    for conv in ids:
        own = sorted(kept[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len({*turns}) if turns else 0
        seen, kinds, faults = set(), "", Counter()
        for _, role, text in own:
            shown = re.findall("[^\x20\x09-\x0d]", text)
            kind = role[:1] if role[:1] and role[:1] in "sua" else "o"
            if not shown:
                fault, kind = "blank", "-"
            elif (role, text) in seen:
                fault, kind = "duplicate", "-"
            elif shown[-1] not in ".!?":
                fault, kind = "truncated", kind.upper()
            else:
                fault = None
            faults[fault] += 1
            kinds += kind
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = _by_search(kinds)
        left, lines, initials = iter(own), [], ""
        for edit in audit:
            _, role, text = ("", "", "") if edit == "I" else next(left)
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if initials[-1:] == "u" else "user"
            lines.append(f"{role}:{text}")
            initials += role[0]
        assert LEGAL.fullmatch(initials)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha] += 1
    return out


@pytest.fixture(scope="module")
def table_of(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x", 1, True, "y") for r in rows],
                                     "conv_id long, turn long, role string, text string, key string, chunk int, mark boolean, audit string")
    return make


def _rows(df):
    return cv.damaged(cv.rows_of(df, code=cv.damage_code()))


def _run(df):
    rows = _rows(df)
    found = cv.with_digest(rows, cv.analyse(rows)).drop("key")
    return Counter(tuple(r) for r in found.collect())


ROLES = ["user", "assistant", "system", "tool", "User", "u", "", None, "assistant", "user"]
TEXTS = ["Yes.", "No!", "cut off", "", " \t\n\x0b", None, "Why? \n", "日本。", "ok.", "\xa0", "a b", "..."]


def test_random_conversations(table_of):
    rng = random.Random(8)
    rows = [(conv, turn, rng.choice(ROLES[:2] if rng.random() < 0.6 else ROLES), rng.choice(TEXTS) if rng.random() < 0.4 else f"{conv} {turn}.")
            for conv in range(120) for turn in range(rng.randrange(1, 12))]
    rng.shuffle(rows)
    assert _run(table_of(rows)) == _plain(rows)


def test_conversations_of_many_chunks(table_of, monkeypatch):
    rng = random.Random(9)
    rows = [(7, turn, ("user", "assistant")[turn % 2], f"{rng.randrange(400)}.") for turn in range(-700, 900) if turn % 11]
    rows += [(8, 10 ** 15 * i, "user", "far.") for i in range(5)] + [(9, None, "user", "none."), (9, 3, "assistant", "none.")]
    rng.shuffle(rows)
    assert _run(table_of(rows)) == _plain(rows)
    monkeypatch.setattr(cv, "TURN_BITS", 2)
    monkeypatch.setattr(cv, "ROWS_AT_ONCE", 5)
    assert _run(table_of(rows)) == _plain(rows)


def test_defined_cases(table_of):
    rows = [(None, 0, "user", "Hi."), (None, 1, "assistant", "Yes."), (1, None, "user", "a."), (1, None, "assistant", "b."),
            (1, None, "assistant", "b."), (2, 5, None, None), (3, 1, "user", "x" * 500_000), (3, 2, "assistant", "." * 9)]
    rows += [(4, 0, "user", "same.")] * 3 + [(conv, 0, "system", "Only.") for conv in range(10, 60)]
    assert any(crc32(f"{c}:0".encode()) % 20 == 0 for c in range(10, 60))  # all rows dropped
    assert _run(table_of(rows)) == _plain(rows)
    assert _run(table_of([])) == Counter()


def test_repaired_rows(table_of):
    rows = cv.rows_of(table_of([(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "tool", "Yes"),
                                (1, 3, "assistant", ""), (2, 0, "user", "")]))
    found = cv.repaired(rows, cv.analyse(rows)).orderBy("conv", "position").collect()
    assert [tuple(r)[1:] for r in found] == [
        (1, 0, "K", "system", "Be kind."), (1, 1, "I", "user", ""), (1, 2, "K", "assistant", "Hello.")]
