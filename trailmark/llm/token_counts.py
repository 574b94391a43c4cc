"""Token counts of a byte-fallback BPE vocabulary by a finite-state transducer.

The transducer reads a text character by character.  Its state knows, for
the last few positions, the last token of the tokenization of the text up
to there: the token that ends at the next position is the one vocabulary
piece that fits behind one of those (two tokens fit if merging their joined
text gives just the two back).  Each transition is annotated with the
number of tokens by which the count changes, so the count of a text is the
sum over its path.  States and transitions are compiled when they are first
met, up to ``STATES`` of them per Python worker; a path that leaves them is
walked with the same rule and not kept.

A piece never holds a space behind another character, so the transducer is
back in its first state wherever a space begins: such units are counted on
their own, and the units met last are kept with their counts.

A long text is cut into chunks of ``CHUNK`` characters, wherever that falls.
Each chunk gets its map from entry states to (exit state, count) without
knowing what the chunks before it come to: it is worked out for the state
that the ``LOOK_BACK`` characters in front lead to, which is the real one if
a unit starts there and nearly always otherwise.  Behind the first unit's
start all entries share one path, and paths of different entries are joined
again as soon as they meet at one of the marks of a chunk.  The maps are
composed by a prefix scan; where a composition enters a map by a state that
it lacks, the map is extended by that state, so the counts are exact for
any text, one without spaces included.

Defined cases: a null text is an empty one and has no tokens; characters
outside the vocabulary count one token per UTF-8 byte; special strings in a
text are ordinary text; repeated rows each give a row; other columns are
not carried.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import map_texts

CHUNK, MARK, LOOK_BACK = 1 << 16, 1 << 10, 1 << 8
STATES = 250_000
CACHE_PAIRS = 300_000
CACHE_UNITS = 300_000
CACHE_CHARS = 64
SPACE = "▁"
_NORMAL = (1, 4, 5)  # normal, user-defined and unused pieces take part in merges


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def pieces_of(path: str) -> dict[str, int]:
    """Rank of every piece that merges can make (lower merges first)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = [i for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    ordered = sorted(usable, key=lambda i: (-model.get_score(i), i))
    return {model.id_to_piece(i): rank for rank, i in enumerate(ordered)}


# a state: the characters read last that a longer piece may start with, then
# for every position among them, the last token up to it and the count there,
# relative to the count now
State = tuple[str, tuple, tuple]
START: State = ("", ("",), (0,))


class Transducer:
    """Compiled states are numbers; state 0 is the start of a unit."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        if any(SPACE in p.lstrip(SPACE) for p in ranks):
            raise ValueError("a piece holds a space behind another character")
        self.longest = max(map(len, ranks))
        self.starts = {p[:n] for p in ranks for n in range(1, len(p))}
        self.fits: dict[tuple[str, str], bool] = {}
        self.units: dict[str, int] = {}
        self.reset()

    def reset(self) -> None:
        self.states: list[State] = [START]
        self.number = {self.states[0]: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.walked = 0

    # -- compilation -----------------------------------------------------------
    def merge(self, text: str) -> list[str]:
        """Tokens of a short text by its merges: best rank, then leftmost."""
        parts, ranks, none = list(text), self.ranks, len(self.ranks)
        adjacent = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while adjacent and (least := min(adjacent)) < none:
            i = adjacent.index(least)
            parts[i] += parts.pop(i + 1)
            del adjacent[i]
            if i < len(adjacent):
                adjacent[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                adjacent[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return parts

    def fit(self, left: str, right: str) -> bool:
        """Whether ``right`` can be the token behind ``left`` (empty: the start)."""
        key = left, right
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= CACHE_PAIRS:
                self.fits.clear()
            found = self.fits[key] = self.merge(left + right) == ([left, right] if left else [right])
        return found

    def next(self, state: State, char: str) -> tuple[State, int]:
        """The transition of ``state`` by ``char``: next state and the number
        of tokens by which the count changes."""
        recent, last, counts = state
        recent += char
        for at in range(len(recent)):  # longest first
            token = recent[at:]
            if (len(token) == 1 or token in self.ranks) and self.fit(last[at], token):
                break
        else:
            raise AssertionError("no token fits")
        cost = 1 if token in self.ranks else len(token.encode())
        change = counts[at] + cost
        last, counts = (*last, token), tuple(c - change for c in (*counts, change))
        keep = 0  # the longest end of what was read that a piece may start with
        while recent[keep:] not in self.starts and keep < len(recent):
            keep += 1
        # what lies at a position where no piece can start any more is forgotten
        recent, last, counts = recent[keep:], last[keep:], counts[keep:]
        live = [at == len(recent) or recent[at:] in self.starts for at in range(len(recent) + 1)]
        reached = (recent, tuple(x if on else "" for x, on in zip(last, live)),
                   tuple(x if on else 0 for x, on in zip(counts, live)))
        return reached, change

    def move(self, state: int, char: str) -> tuple[int, int]:
        """The same between compiled states, kept."""
        reached, change = self.next(self.states[state], char)
        number = self.number.get(reached)
        if number is None:
            number = self.number[reached] = len(self.states)
            self.states.append(reached)
            self.moves.append({})
        self.moves[state][char] = number, change
        return number, change

    # -- running ---------------------------------------------------------------
    def run(self, unit: str) -> int:
        """Tokens of one unit."""
        state = total = 0
        moves = self.moves
        for char in unit:
            step = moves[state].get(char)
            if step is None:
                if len(self.states) >= STATES:
                    return self.walk(unit)
                step = self.move(state, char)
            state, change = step
            total += change
        return total

    def walk(self, unit: str) -> int:
        """The same without compiling: for every position the last token up
        to there and the count.  If this goes on for long, the texts have
        changed and the compiled states make room for others."""
        self.walked += 1
        if self.walked > STATES:
            self.reset()
        ranks, fits, longest = self.ranks, self.fits, self.longest
        last: list[str] = [""]
        counts = [0]
        for end in range(1, len(unit) + 1):
            for start in range(max(0, end - longest), end):
                token = unit[start:end]
                if token in ranks or start == end - 1:
                    fit = fits.get((last[start], token))
                    if self.fit(last[start], token) if fit is None else fit:
                        break
            last.append(token)
            counts.append(counts[start] + (1 if token in ranks else len(token.encode())))
        return counts[-1]

    def unit(self, unit: str) -> int:
        count = self.units.get(unit)
        if count is None:
            count = self.run(unit)
            if len(unit) <= CACHE_CHARS:
                if len(self.units) >= CACHE_UNITS:
                    self.units.clear()
                self.units[unit] = count
        return count

    # -- chunks ----------------------------------------------------------------
    def follow(self, state: State, stretch: str) -> tuple[State, int]:
        """Exit state and tokens of a stretch of one unit, entered by ``state``."""
        if self.walked > STATES:
            self.reset()
        number, total = self.number.get(state), 0
        for char in stretch:
            step = None if number is None else self.moves[number].get(char)
            if step is None and number is not None and len(self.states) < STATES:
                step = self.move(number, char)
            if step is None:  # from or to a state that is not compiled
                self.walked += 1
                state, change = self.next(state if number is None else self.states[number], char)
                number = self.number.get(state)
            else:
                number, change = step
            total += change
        return (state if number is None else self.states[number]), total

    def chunk_map(self, text: str, at: int, end: int) -> ChunkMap:
        """The map of ``text[at:end]``."""
        starts = _STARTS.search(text, at, end)
        path = Path(self, text[at:starts.start() if starts else end])
        if not starts:
            return ChunkMap(path.follow, self.entries(text, at))
        *units, behind = _UNITS(text, starts.start(), end)
        leave, inside = self.follow(START, behind)
        inside += sum(map(self.unit, units))
        return ChunkMap(lambda entry: (leave, path.follow(entry)[1] + inside), self.entries(text, at))

    def entries(self, text: str, at: int) -> list[State]:
        """The states by which a chunk is likely entered at ``at``."""
        begin = max(0, at - LOOK_BACK)
        for start in _STARTS.finditer(text, begin, at):
            begin = start.start()
        return [self.follow(START, text[begin:at])[0]]

    def counts(self, text: str) -> list[int]:
        """Tokens of a normalized text up to the end of each of its chunks."""
        maps = [self.chunk_map(text, at, min(at + CHUNK, len(text))) for at in range(0, len(text), CHUNK)]
        return [prefix(START)[1] for prefix in scan(maps)]

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if len(text) > CHUNK:
            return self.counts(text)[-1]
        known, total = self.units, 0
        for u in _UNITS(text):
            count = known.get(u)
            total += self.unit(u) if count is None else count
        return total


class Path:
    """The runs of one stretch from several entry states.  The states at its
    marks are kept with what follows, so a run ends where it meets another."""

    def __init__(self, machine: Transducer, stretch: str):
        self.machine, self.stretch = machine, stretch
        self.met: dict[tuple[int, State], tuple[State, int]] = {}

    def follow(self, state: State) -> tuple[State, int]:
        passed, rest = [], None
        for mark in range(0, len(self.stretch), MARK):
            rest = self.met.get((mark, state))
            if rest:
                break
            reached, count = self.machine.follow(state, self.stretch[mark:mark + MARK])
            passed.append((mark, state, count))
            state = reached
        leave, total = rest or (state, 0)
        for mark, state, count in reversed(passed):
            total += count
            self.met[mark, state] = leave, total
        return leave, total


class ChunkMap:
    """The map of a stretch from entry states to (exit state, tokens), known
    for the entries met; ``follow`` extends it by another one."""

    def __init__(self, follow: Callable[[State], tuple[State, int]], entries: Iterable[State]):
        self.follow = follow
        self.known = {entry: follow(entry) for entry in entries}

    def __call__(self, entry: State) -> tuple[State, int]:
        found = self.known.get(entry)
        if found is None:
            found = self.known[entry] = self.follow(entry)
        return found

    def then(self, behind: ChunkMap) -> ChunkMap:
        """The map of this stretch and the one behind it together."""
        def follow(entry: State) -> tuple[State, int]:
            state, count = self(entry)
            leave, more = behind(state)
            return leave, count + more
        return ChunkMap(follow, self.known)


def scan(maps: list[ChunkMap]) -> list[ChunkMap]:
    """The composition of the maps up to each one: neighbours are composed,
    the pairs are scanned, and every second prefix takes one map more."""
    if len(maps) < 2:
        return maps
    even = scan([a.then(b) for a, b in zip(maps[::2], maps[1::2])])
    odd = [prefix.then(one) for prefix, one in zip(even, maps[2::2])]
    return [maps[0], *chain.from_iterable(zip(even, odd)), *even[len(odd):]]


# a unit starts at a space that is the first of its run
_STARTS = re.compile(f"(?<!{SPACE}){SPACE}")
_UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """The transducer of ``path``, one per Python worker."""
    return Transducer(pieces_of(path))


def count_tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 model: str | None = None, limit: int = 4096) -> DataFrame:
    """Columns ``id_col``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``."""
    path = model or default_model()

    def make():
        count = transducer(path).count
        return lambda text: (len(text.encode()), count(text))

    counted = map_texts(docs, id_col, text_col, make,
                        [("n_bytes", pa.int64(), "long"), ("n_tokens", pa.int64(), "long")])
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
