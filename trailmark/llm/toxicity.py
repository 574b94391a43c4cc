"""Toxicity scores from a convolutional text classifier.

Words are hashed into buckets with an embedding each; filters of several
widths slide over the whole text, max pooling keeps each filter's strongest
answer, and a logistic layer gives the score.  The network is trained in
numpy on the driver from a bounded sample of labelled rows
(``SAMPLE_PER_CLASS`` of each class in hash order, texts of at most
``SAMPLE_CHARS`` characters); everything else, scoring included, covers
every row and the whole of its text.

Labels are learnt only from rows whose crc32(id as text) mod ``FOLDS`` is
not 0, and a fifth of the sample is kept out of the training.  One threshold
per language is chosen for the most correct answers on all labelled rows
outside of fold 0 and of the training: each is scored, and counts by
language, label and bin of the score (``BINS`` to a unit, up to
``BIN_LIMIT``) go to the driver; the language is guessed from the function words of the text itself, so
labels, lang, source and ids are no inputs of a score.  Scores are shifted
so that the threshold of the guessed language is 0.5.

The embedding of a bucket that the sample holds in fewer than
``LEAST_DOCUMENTS`` texts is zero; one dimension starts from the bucket's
class log-odds in the sample, the others at random (fixed seed).

Defined cases: null and empty texts score as a text of one unknown word;
rows without an id are scored but never learnt from; labels repeated for an
id count as toxic if one of them is; without labels of both classes every
score is 0; other columns are not carried.
"""

from __future__ import annotations

import codecs
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import TEXT_BYTES, each_text, let_go, sized_slices

SAMPLE_PER_CLASS = 3000
SAMPLE_CHARS = 20_000
FOLDS = 5
BUCKETS = 1 << 24
LEAST_DOCUMENTS = 3
DIMENSIONS, FILTERS, WIDTHS = 16, 12, (1, 2, 3)
EPOCHS = 3
WORDS_AT_ONCE = 1 << 14
CACHE_WORDS = 200_000
BINS, BIN_LIMIT = 64, 32
LEAST_CALIBRATION = 30

# Common function words by language
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for with as on be at by this have from or are an not",
    "de": "der die und das den von zu mit ist im nicht ein eine auf für des dem sich auch es an als",
    "fr": "le la les de des et un une est dans que pour qui sur pas au par du ne se en ce il",
    "es": "el la los las de y que en un una es por con para del se no al lo como más su",
}
LANGUAGES = list(FUNCTION_WORDS)
_WORDS = re.compile(r"[^\W_]+").findall
# every Latin-1 character in lower case, a space for those that no word has
_FOLDED = bytes(ord(c) if _WORDS(c) else 32 for c in map(str.lower, map(chr, range(256))))


def _blank(error: UnicodeError) -> tuple[str, int]:
    """A space for characters beyond Latin-1, unless words have them."""
    if _WORDS(error.object[error.start:error.end].lower()):
        raise error
    return " ", error.end


codecs.register_error("trailmark.blank", _blank)


def split_words(text: str) -> list[str]:
    """The words of a text in lower case, runs of letters and digits.  Texts
    without letters or digits beyond Latin-1 are folded and split as a whole,
    others by the expression; both give the same words."""
    try:
        return text.encode("latin-1", "trailmark.blank").translate(_FOLDED).decode("latin-1").split()
    except UnicodeEncodeError:
        return _WORDS(text.lower())


def bucket(word: str) -> int:
    return zlib.crc32(word.encode()) & (BUCKETS - 1)


@lru_cache(maxsize=1)
def _function_rows() -> tuple[list[str], np.ndarray]:
    """The function words, and which languages have each."""
    words = sorted({w for text in FUNCTION_WORDS.values() for w in text.split()})
    return words, np.array([[w in FUNCTION_WORDS[x].split() for x in LANGUAGES] for w in words], dtype=np.int64)


def guess_language(rows: np.ndarray) -> int:
    """Index of the language with most function words; the last index of all
    stands for none.  Rows 1 to n are the function words."""
    words, belongs = _function_rows()
    counts = np.bincount(rows[rows <= len(words)], minlength=len(words) + 1)[1:len(words) + 1] @ belongs
    return int(counts.argmax()) if counts.any() else len(LANGUAGES)


@dataclass
class Network:
    """``buckets`` has the bucket of every embedding row but row 0, which
    stands for all other words and stays zero."""

    buckets: np.ndarray
    embedding: np.ndarray
    filters: list[np.ndarray]  # width x dimensions x filters, by growing width
    filter_bias: np.ndarray
    out: np.ndarray
    bias: float
    thresholds: np.ndarray

    def table(self) -> tuple[np.ndarray, list[int]]:
        """The answers of all filters to each word in one row: those of the
        filters' first position, then of the second position of those that
        have one, and so on; and how many answers each position has."""
        parts = [f[k] for k in range(max(WIDTHS)) for f in self.filters if len(f) > k]
        sizes = [sum(f.shape[2] for f in self.filters if len(f) > k) for k in range(max(WIDTHS))]
        table, at = np.empty((len(self.embedding), sum(sizes))), 0
        for part in parts:
            table[:, at:at + part.shape[1]] = self.embedding @ part
            at += part.shape[1]
        return table, sizes


class Scorer:
    """A network with the rows of the words met last, for one task."""

    def __init__(self, network: Network):
        self.network = network
        self.table, self.sizes = network.table()
        self.seen = np.empty((WORDS_AT_ONCE + max(WIDTHS) - 1, self.table.shape[1]))
        self.row_of = {int(b): i + 1 for i, b in enumerate(network.buckets)}
        self.cache: dict[str, int] = {}

    def rows(self, text: str) -> np.ndarray:
        words, cache = split_words(text), self.cache
        found = list(map(cache.get, words))
        if None in found:
            if len(cache) > CACHE_WORDS:
                cache.clear()
            for i, row in enumerate(found):
                if row is None:
                    found[i] = cache[words[i]] = self.row_of.get(bucket(words[i]), 0)
        return np.array(found or [0], dtype=np.int64)

    def logit(self, text: str) -> tuple[float, int]:
        """The answer before the threshold, and the language guessed."""
        net, rows = self.network, self.rows(text)
        widest = max(WIDTHS)
        pooled = np.full(len(net.filter_bias), -np.inf)
        padded = np.concatenate([rows, np.zeros(widest - 1, dtype=np.int64)])
        for at in range(0, len(rows), WORDS_AT_ONCE):
            part = padded[at:at + WORDS_AT_ONCE + widest - 1]
            n = len(part) - widest + 1
            # every row is in the table; "clip" only spares numpy a second buffer
            seen = np.take(self.table, part, axis=0, out=self.seen[:len(part)], mode="clip")
            best, start = seen[:n, :len(pooled)], len(pooled)
            for k, size in enumerate(self.sizes[1:], 1):
                best[:, len(pooled) - size:] += seen[k:k + n, start:start + size]
                start += size
            np.maximum(pooled, best.max(axis=0), out=pooled)
        return float(np.maximum(pooled + net.filter_bias, 0) @ net.out + net.bias), guess_language(rows)

    def score(self, text: str) -> float:
        logit, language = self.logit(text)
        logit -= self.network.thresholds[language]
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def scorer(shared) -> Scorer:
    """The scorer of a task, gone at its end; what tasks of other operators
    have left in the worker goes now."""
    let_go()
    return Scorer(shared.value)


# -- training on the driver ---------------------------------------------------

def train(samples: list[tuple[int, np.ndarray]], seed: int = 7) -> Network | None:
    """A network from (label, buckets of the words) pairs in a fixed order,
    every fifth of which is kept out, with thresholds of 0; None without both labels."""
    fit = [s for i, s in enumerate(samples) if i % FOLDS]
    if len({label for label, _ in fit}) < 2:
        return None
    rng = np.random.default_rng(seed)
    counts = [Counter(), Counter()]
    for label, words in fit:
        counts[label].update(np.unique(words).tolist())
    functions = [bucket(w) for w in _function_rows()[0]]
    common = sorted({b for b, n in (counts[0] + counts[1]).items() if n >= LEAST_DOCUMENTS} - {*functions})
    buckets = np.array(functions + common, dtype=np.int64)
    totals = [sum(label == x for label, _ in fit) for x in (0, 1)]
    odds = [np.log((counts[1][b] + 0.5) / (totals[1] + 1)) - np.log((counts[0][b] + 0.5) / (totals[0] + 1))
            for b in buckets.tolist()]
    embedding = rng.normal(0, 0.1, (len(buckets) + 1, DIMENSIONS))
    embedding[1:, 0] = np.array(odds) / 4
    embedding[0] = 0
    filters = [rng.normal(0, 0.2, (w, DIMENSIONS, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[:, 0] = np.abs(f[:, 0])
    net = Network(buckets, embedding, filters, np.zeros(FILTERS * len(WIDTHS)),
                  np.abs(rng.normal(0, 0.2, FILTERS * len(WIDTHS))), 0.0, np.zeros(len(LANGUAGES) + 1))
    row_of = {int(b): i + 1 for i, b in enumerate(buckets)}
    rows = [(label, np.array([row_of.get(w, 0) for w in words.tolist()] or [0], dtype=np.int64))
            for label, words in samples]
    _descend(net, [r for i, r in enumerate(rows) if i % FOLDS], rng)
    net.embedding = net.embedding.astype(np.float32)
    return net


def _forward(net: Network, rows: np.ndarray):
    widest = max(WIDTHS)
    padded = np.concatenate([rows, np.zeros(widest - 1, dtype=np.int64)])
    seen = net.embedding[padded]
    n = len(rows)
    places, pooled = [], []
    for f in net.filters:
        answers = sum(seen[k:k + n] @ f[k] for k in range(len(f)))
        at = answers.argmax(axis=0)
        places.append(at)
        pooled.append(answers[at, np.arange(FILTERS)])
    hidden = np.maximum(np.concatenate(pooled) + net.filter_bias, 0)
    return padded, seen, places, hidden, float(hidden @ net.out + net.bias)


def _descend(net: Network, rows: list, rng, rate: float = 0.1) -> None:
    """Stochastic gradient descent with rates by accumulated squares."""
    parts = [net.embedding, *net.filters, net.filter_bias, net.out]
    squares = [np.full_like(p, 0.1) for p in parts]
    bias_square = 0.1
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            label, words = rows[i]
            padded, seen, places, hidden, logit = _forward(net, words)
            error = 1 / (1 + np.exp(-np.clip(logit, -50, 50))) - label
            back = error * net.out * (hidden > 0)
            for j, f in enumerate(net.filters):
                g = back[j * FILTERS:(j + 1) * FILTERS]
                for k in range(len(f)):
                    at = places[j] + k
                    to_filter = seen[at].T * g
                    ids = padded[at]
                    to_words = np.zeros((FILTERS, DIMENSIONS))
                    known, slot = np.unique(ids, return_inverse=True)
                    np.add.at(to_words, slot, (f[k] * g).T)
                    squares[j + 1][k] += to_filter ** 2
                    f[k] -= rate * to_filter / np.sqrt(squares[j + 1][k])
                    keep = known > 0
                    known, to_words = known[keep], to_words[:len(known)][keep]
                    squares[0][known] += to_words ** 2
                    net.embedding[known] -= rate * to_words / np.sqrt(squares[0][known])
            for p, s, g in ((net.filter_bias, squares[-2], back), (net.out, squares[-1], error * hidden)):
                s += g ** 2
                p -= rate * g / np.sqrt(s)
            bias_square += error ** 2
            net.bias -= rate * error / np.sqrt(bias_square)


def _thresholds(counts: list[tuple[int, int, int, int]]) -> np.ndarray:
    """The threshold with most correct answers by language, and over all for
    languages with few rows; of equals, the one nearest to that over all.
    ``counts`` has (language, label, bin, rows)."""
    language, label, bins, n = np.array(counts, dtype=np.int64).reshape(-1, 4).T

    def best(here, near):
        if not here.any():
            return near
        places, at = np.unique(bins[here], return_inverse=True)
        toxic, clean = (np.bincount(at, n[here] * (label[here] == x), len(places)) for x in (1, 0))
        edges = np.concatenate([[places[0] - BINS], (places[1:] + places[:-1] + 1) / 2, [places[-1] + 1 + BINS], [near * BINS]])
        below = np.searchsorted(places, edges)  # bins under the threshold
        right = np.append(0, clean.cumsum())[below] + toxic.sum() - np.append(0, toxic.cumsum())[below]
        return min(edges[right == right.max()] / BINS, key=lambda c: abs(c - near))

    over_all = best(n > 0, 0.0)
    return np.array([best(language == x, over_all) if n[language == x].sum() >= LEAST_CALIBRATION else over_all
                     for x in range(len(LANGUAGES) + 1)])


# -- operators ----------------------------------------------------------------

def fold(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample: int = SAMPLE_PER_CLASS) -> Network | None:
    """Train from the rows of ``labels`` outside fold 0."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
             .where("id is not null and label is not null").where(fold("id") != 0)
             .groupBy("id").agg((F.max("label") > 0).cast("int").alias("label"))
             .withColumn("at", F.xxhash64("id")))
    # at most ``sample`` ids of each class, so small enough to broadcast
    chosen = known.where("label = 1").orderBy("at", "id").limit(sample).unionByName(
        known.where("label = 0").orderBy("at", "id").limit(sample))
    every = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = every.where(F.length("text") <= SAMPLE_CHARS)
    texts = (texts.join(F.broadcast(chosen), "id").orderBy("at", "id", "text").limit(2 * sample)
             .select("label", "text", "id"))

    def run(batches):
        for batch in sized_slices(batches, TEXT_BYTES):
            words = [np.array([bucket(w) for w in split_words(t)], dtype=np.int32).tobytes()
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary()), batch.column(2)],
                                             names=["label", "words", "id"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts.mapInArrow(run, f"label int, words binary, id {kind}").collect()
    network = train([(r["label"], np.frombuffer(r["words"], dtype=np.int32)) for r in rows])
    if network is not None:
        fitted = docs.sparkSession.createDataFrame([(r["id"],) for i, r in enumerate(rows) if i % FOLDS], f"id {kind}")
        network.thresholds = _thresholds(_counts(every, known, fitted, network))
    return network


def _counts(texts: DataFrame, known: DataFrame, fitted: DataFrame, network: Network) -> list:
    """(language, label, bin, rows) of all labelled texts but those of the
    ``fitted`` ids.  Scored before the join, so no text is shuffled."""
    shared = texts.sparkSession.sparkContext.broadcast(network)  # bounded by the sample

    def run(batches):
        logit = scorer(shared).logit
        for batch in sized_slices(batches, TEXT_BYTES):
            found = [logit(t) for t in batch.column(1).to_pylist()]
            bins = [int(np.clip(np.floor(x * BINS), -BIN_LIMIT * BINS, BIN_LIMIT * BINS - 1)) for x, _ in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([y for _, y in found], pa.int32()),
                                              pa.array(bins, pa.int32())], names=["id", "language", "bin"])

    asked = texts.where("id is not null").where(fold("id") != 0).join(F.broadcast(fitted), "id", "left_anti")
    kind = texts.schema["id"].dataType.simpleString()
    scored = asked.select("id", "text").mapInArrow(run, f"id {kind}, language int, bin int")
    # at most one row for each language, label and bin
    counts = scored.join(known.select("id", "label"), "id").groupBy("language", "label", "bin").count().collect()
    shared.unpersist()
    return [tuple(r) for r in counts]


def score_column(docs: DataFrame, network: Network | None, text_col: str = "text") -> Column:
    """The score of each text, from 0 to 1, 0.5 being the threshold."""
    if network is None:
        return F.lit(0.0)
    shared = docs.sparkSession.sparkContext.broadcast(network)  # bounded by the sample

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return each_text(batches, scorer(shared).score, pa.float64())

    return F.arrow_udf(scores, "double")(F.coalesce(F.col(text_col), F.lit("")))


def score(docs: DataFrame, network: Network | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``id_col``, ``held_out``, ``score`` and ``predicted``."""
    scored = docs.select(F.col(id_col), score_column(docs, network, text_col).alias("score"))
    return scored.select(
        F.col(id_col), F.coalesce(fold(id_col) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
