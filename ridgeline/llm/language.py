"""Language identification: unigram pieces of a fixed vocabulary, all segmentations summed.

A text in lower case is read as units: one blank and a word (a run without white
space). A unit may be cut into pieces of the vocabulary in many ways; under a
language its probability is the sum over all of them of the product of the
pieces' probabilities, which the forward algorithm adds up in one pass over the
bytes. The probability of a text is the product over its units, times the share
of the language among the documents learned from.

Learning is expectation maximisation over all rows that may be learned from:
each round takes the expected number of uses of every piece under the last
probabilities (forward and backward), beginning with equal ones. Tasks add up
their own (language, piece) table, so only counts are shuffled, and the model is
a table of languages by pieces whatever the size of the corpus. Counts are whole
multiples of 2**-16, so sums do not depend on the order of the tasks.

Every word of every text counts. A distinct word of a chunk is walked once; words
longer than ``STRETCH`` bytes are scored in stretches of that many bytes, no
segmentation crosses a stretch. Bytes that the vocabulary lacks are pieces too.

Defined cases: null texts and texts without a letter give ``und`` and score 0, as
all do when nothing was learned. Empty texts have no letter. Rows without a
doc_id or a language are not learned from and are scored like others. Repeated
rows give repeated results. Ties go to the first language by name. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import arrow_map, chunks, documents

#: Bytes of a unit that are segmented together, and of the longest piece.
STRETCH, LONGEST = 32, 16
#: Bits by which probabilities are raised for each byte, so that products stay within doubles; and the least probability.
RAISE, LEAST = 8, 1e-10
#: Bytes of distinct words walked at a time (for one language; fewer with more).
WALK_BYTES = 1 << 20
#: Numbers that a task remembers for words it has met (a word has one for each language).
REMEMBER = 1 << 21
UNKNOWN = "und"
_END = 256
_SCALE = 1 << 16


class Vocabulary:
    """A trie over pieces, walked from all positions of many units at once."""

    def __init__(self, pieces: list[bytes]):
        known = {p for p in pieces if 0 < len(p) <= LONGEST} | {bytes([b]) for b in range(256)}
        self.pieces = sorted(known)
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        children: list[dict[int, int]] = [{}]
        final = [-1]
        for number, piece in enumerate(self.pieces):
            node = 0
            for b in piece:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                    final.append(-1)
                node = children[node][b]
            final[node] = number
        # Nodes with children first: only they need a row of the table.
        order = sorted(range(len(children)), key=lambda n: not children[n])
        place = np.zeros(len(children), np.int32)
        place[order] = np.arange(len(children))
        self.inner = sum(1 for c in children if c)
        self.next = np.full((self.inner, _END + 1), -1, np.int32)
        for node, below in enumerate(children):
            for b, child in below.items():
                self.next[place[node], b] = place[child]
        self.final = np.array(final, np.int64)[order]

    def __len__(self) -> int:
        return len(self.pieces)

    def lattice(self, units: list[bytes]) -> Lattice:
        return Lattice(self, units)


class Lattice:
    """All pieces that stand anywhere in the units, as edges between positions."""

    def __init__(self, words: Vocabulary, units: list[bytes]):
        sizes = np.array([len(u) for u in units], np.int64)
        self.sizes = sizes
        self.last = np.cumsum(sizes + 1) - 1
        self.first = self.last - sizes
        data = np.full(int(self.last[-1]) + 1 if len(units) else 0, _END, np.int16)
        inside = np.ones(len(data), bool)
        inside[self.last] = False
        data[inside] = np.frombuffer(b"".join(units), np.uint8)
        at = np.flatnonzero(inside)
        state, now = np.zeros(len(at), np.int32), at
        starts, pieces = [], []
        for _ in range(LONGEST):
            state = words.next[state, data[now]]
            alive = state >= 0
            state, at, now = state[alive], at[alive], now[alive] + 1
            number = words.final[state]
            hit = number >= 0
            starts.append(at[hit])
            pieces.append(number[hit])
            more = state < words.inner
            state, at, now = state[more], at[more], now[more]
            if not len(at):
                break
        start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        piece = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
        unit = np.repeat(np.arange(len(units)), sizes + 1)[start]
        # By offset of their start; no two of one offset end at the same position.
        order, self.cuts = self._by_offset(start - self.first[unit])
        self.start, self.piece, self.unit = start[order], piece[order], unit[order]
        self.end = self.start + words.lengths[self.piece]

    @staticmethod
    def _by_offset(offset: np.ndarray) -> tuple[np.ndarray, list[int]]:
        offset = offset.astype(np.int16)
        order = np.argsort(offset, kind="stable")
        return order, np.searchsorted(offset[order], np.arange(STRETCH + 2)).tolist()

    def forward(self, table: np.ndarray, column: np.ndarray | None = None) -> np.ndarray:
        """Sums over all ways to reach each position: for all languages, or for that of ``column`` (one for each unit)."""
        alpha = np.zeros((int(self.last[-1]) + 1 if len(self.last) else 0, *(table.shape[1:] if column is None else ())))
        alpha[self.first] = 1
        for a, b in zip(self.cuts[:-1], self.cuts[1:]):
            raised = table[self.piece[a:b]] if column is None else table[self.piece[a:b], column[self.unit[a:b]]]
            alpha[self.end[a:b]] += alpha[self.start[a:b]] * raised
        return alpha

    def log_probability(self, table: np.ndarray) -> np.ndarray:
        """Of each unit under each language; ``table`` is of ``Model.raised``."""
        total = self.forward(table)[self.last]
        return np.log(total) - (self.sizes * (RAISE * np.log(2)))[:, None]

    def expected(self, table: np.ndarray, language: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected uses of every piece for each language, of units that occur ``times`` in a language."""
        alpha = self.forward(table, language)
        raised = table[self.piece, language[self.unit]]
        beta = np.zeros(len(alpha))
        beta[self.last] = 1
        # Backwards by offset of their end; no two of one offset start at the same position.
        order, cuts = self._by_offset(self.end - self.first[self.unit])
        start, end, ordered = self.start[order], self.end[order], raised[order]
        for a, b in reversed(list(zip(cuts[:-1], cuts[1:]))):
            beta[start[a:b]] += beta[end[a:b]] * ordered[a:b]
        share = alpha[self.start] * raised * beta[self.end] * (times / alpha[self.last])[self.unit]
        size = table.shape
        return np.bincount(language[self.unit] * size[0] + self.piece, share, size[0] * size[1]).reshape(size[1], size[0])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The pieces of a file of base64 pieces and ranks, one per line."""
    with open(path, "rb") as lines:
        return Vocabulary([base64.b64decode(line.split()[0]) for line in lines if line.strip()])


def _blocks(words: list[str], languages: int) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Stretches of words, a bounded number of bytes at a time, and the places of their words."""
    most = max(STRETCH, WALK_BYTES // max(1, languages))
    units, owner, size = [], [], 0
    for i, word in enumerate(words):
        data = b" " + word.encode("utf-8", "surrogatepass")
        for a in range(0, len(data), STRETCH):
            if size >= most:
                yield units, np.array(owner, np.int64)
                units, owner, size = [], [], 0
            units.append(data[a : a + STRETCH])
            owner.append(i)
            size += STRETCH if a else len(data)
    if units:
        yield units, np.array(owner, np.int64)


@dataclass(frozen=True)
class Model:
    """Languages in order of their names, their shares, and the probabilities of the pieces (pieces x languages)."""

    path: str
    languages: tuple[str, ...]
    share: np.ndarray
    table: np.ndarray

    def raised(self) -> np.ndarray:
        return raise_by_length(vocabulary(self.path), self.table)


class Scorer:
    """Scores texts under a model and remembers the words of the texts before, up to a bound."""

    def __init__(self, model: Model):
        self.model, self.trie, self.raised = model, vocabulary(model.path), model.raised()
        self.numbers: dict[str, int] = {}
        self.value = np.zeros((0, len(model.languages)))

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log of share times probability, a row for each text."""
        if len(self.numbers) * max(4, len(self.model.languages)) > REMEMBER:
            self.numbers, self.value = {}, self.value[:0]
        numbers, ids, sizes = self.numbers, [], []
        for text in texts:
            words = text.lower().split()
            ids += [numbers.setdefault(w, len(numbers)) for w in words]
            sizes.append(len(words))
        known = len(self.value)
        new = list(islice(numbers, known, None))
        value = np.zeros((len(new), len(self.model.languages)))
        for units, owner in _blocks(new, len(self.model.languages)):
            np.add.at(value, owner, self.trie.lattice(units).log_probability(self.raised))
        self.value = np.concatenate([self.value, value])
        out = np.tile(np.log(self.model.share), (len(texts), 1))
        sizes = np.array(sizes, np.int64)
        some = np.flatnonzero(sizes)
        if len(some):
            out[some] += np.add.reduceat(self.value[np.array(ids, np.int64)], (np.cumsum(sizes) - sizes)[some])
        return out

    def predict(self, texts: list[str], letters: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(language, posterior of it) of each text; ``letters`` says which texts have one."""
        languages = self.model.languages
        if not languages or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        s = self.scores(texts)
        s = np.exp(s - s.max(axis=1, keepdims=True))
        best = s.argmax(axis=1)
        score = np.where(letters, s[np.arange(len(best)), best] / s.sum(axis=1), 0.0)
        return [languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist())], score


class Counter:
    """Expected uses of pieces for each language, of words that are collected up to a bound before they are walked."""

    def __init__(self, model: Model):
        self.trie, self.raised = vocabulary(model.path), model.raised()
        self.number = {name: i for i, name in enumerate(model.languages)}
        self.seen: dict[tuple[int, str], int] = {}
        self.size = 0
        self.total = np.zeros((len(self.number), len(self.trie)), np.int64)

    def add(self, texts: list[str], langs: list[str]) -> None:
        seen = self.seen
        for text, lang in zip(texts, langs):
            lang = self.number[lang]
            for w in text.lower().split():
                key = (lang, w)
                if key in seen:
                    seen[key] += 1
                else:
                    seen[key] = 1
                    self.size += len(w)
        if len(seen) + self.size // 32 > REMEMBER // 4:
            self.walk()

    def walk(self) -> None:
        language, times = np.array([k[0] for k in self.seen], np.int64), np.array(list(self.seen.values()), np.float64)
        expected = np.zeros(self.total.shape)
        for units, owner in _blocks([k[1] for k in self.seen], 1):
            expected += self.trie.lattice(units).expected(self.raised, language[owner], times[owner])
        self.total += np.rint(expected * _SCALE).astype(np.int64)
        self.seen, self.size = {}, 0


def raise_by_length(trie: Vocabulary, table: np.ndarray) -> np.ndarray:
    return table * np.exp2(RAISE * trie.lengths)[:, None]


def probabilities(counts: np.ndarray, smooth: float) -> np.ndarray:
    """Pieces x languages from expected counts (languages x pieces)."""
    p = (counts + smooth) / (counts + smooth).sum(axis=1, keepdims=True)
    return np.maximum(p, LEAST).T.copy()


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def _counts(rows: DataFrame, model: Model) -> DataFrame:
    """(language, piece, n): expected uses in units of 2**-16, added up in each task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(model)
        for batch in batches:
            for part in chunks(batch):
                counter.add(part.column(0).to_pylist(), part.column(1).to_pylist())
        counter.walk()
        lang, piece = np.nonzero(counter.total)
        for a in range(0, len(lang), 10_000):
            l, p = lang[a : a + 10_000], piece[a : a + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(l, pa.int32()), pa.array(p, pa.int32()), pa.array(counter.total[l, p], pa.int64())], names=["language", "piece", "n"])

    return rows.mapInArrow(run, "language int, piece int, n long").groupBy("language", "piece").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, path: str, rounds: int = 2, smooth: float = 0.1, most_languages: int = 500) -> Model:
    """Piece probabilities of every language of the rows that are not held out, from all their texts.

    Runs a job for the languages and one for each round. To the driver come a
    row for each language and one for each (language, piece).
    """
    rows = docs.select(F.col("text").alias("text"), F.col("lang").cast("string").alias("lang"), held_out().alias("out")).filter("not out and lang is not null and text is not null").select("text", "lang")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(most_languages + 1).collect()
    if len(sizes) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    sizes = sorted((r["lang"], r["n"]) for r in sizes)
    trie, share = vocabulary(path), np.array([n for _, n in sizes], float)
    model = Model(path, tuple(name for name, _ in sizes), share / max(1.0, share.sum()), np.full((len(trie), len(sizes)), 1 / len(trie)))
    for _ in range(rounds if sizes else 0):
        found = _counts(rows, model).toArrow()
        counts = np.zeros((len(sizes), len(trie)))
        counts[found["language"].to_numpy(), found["piece"].to_numpy()] = found["n"].to_numpy() / _SCALE
        model = Model(path, model.languages, model.share, probabilities(counts, smooth))
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""

    scorers: list[Scorer] = []  # one for each task

    def each(batch: pa.RecordBatch) -> dict[str, object]:
        if not scorers:
            scorers.append(Scorer(model))
        names, score = scorers[0].predict(batch.column(1).to_pylist(), np.array(batch.column(3).to_pylist(), bool))
        return {"doc_id": batch.column(0), "held_out": batch.column(2), "lang_pred": names, "score": score}

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter")
    return arrow_map(documents(docs, held_out().alias("held_out"), letter), each, "doc_id long, held_out boolean, lang_pred string, score double")
