"""Toxicity by a support vector machine with a gap-weighted subsequence kernel.

A word's features are its character triples in order, gaps allowed: a triple
that spans s characters weighs ``DECAY ** s``. Two words' kernel is the product of
their features, scaled by the norm that words of their lengths have, cubed; a phrase (a few neighbouring words) sums over its
words. Nyström: the kernel is taken against a set of landmark words only and
whitened by the landmarks' own kernel matrix, so a phrase's score is a sum over
its words. Inserted or doubled characters only widen the spans, so a disguised
insult stays near its landmark. A document scores as its worst phrase.
"""

from __future__ import annotations

import re
import warnings
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import blocks, fresh

DECAY = 0.6
SPAN = 6               # widest triple
PHRASE = 4             # words of a phrase at most
PIECE = 24             # longer words are scored by overlapping pieces of this length
SAMPLE_DOCS = 800      # most labelled documents of each class that the machine is trained on
SAMPLE_BYTES = 32768   # longer documents are not taken into that sample
SCORE_BYTES = 1 << 20  # text that is cut into phrases at a time
COST = 10.0
POWER = 3
LANDMARKS = 64         # of each kind: words of toxic documents, words of clean ones

_END = re.compile(r"[.!?]+(?=\s|$)")
_DROP = re.compile(r"[^\w\s]+|_+")
_SPELT = re.compile(r"(?<!\S)(?:\S[ \t]+){2,}\S(?!\S)")


def phrases(text: str) -> list[list[str]]:
    """Lower-cased different words without punctuation, of at most ``PHRASE`` words of a
    sentence. Letters spelt out with blanks between them are one word."""
    text = _SPELT.sub(lambda m: re.sub(r"[ \t]+", "", m[0]), text.lower())
    out = []
    for sentence in _DROP.sub("", _END.sub("\n", text)).split("\n"):
        words = sentence.split()
        if len(words) <= PHRASE:
            if words:
                out.append(list(dict.fromkeys(words)))
        else:
            out.extend(list(dict.fromkeys(words[i:i + PHRASE])) for i in range(0, len(words), PHRASE))
    return out


def _triples(width: int) -> tuple[np.ndarray, np.ndarray]:
    at = [(i, j, k) for i in range(width) for j in range(i + 1, min(width, i + SPAN)) for k in range(j + 1, min(width, i + SPAN))]
    t = np.array(at, np.int64).reshape(-1, 3)
    return t, DECAY ** (t[:, 2] - t[:, 0] + 1.0) if len(t) else np.zeros(0)


def _features(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By length: (which words, code points with a start and an end mark, triples, weights scaled by the length's norm)."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w) + 2, []).append(i)
    for width, which in groups.items():
        t, weight = _triples(width)
        weight = weight / np.sqrt((weight ** 2).sum())
        for a in range(0, len(which), 4096):
            part = which[a:a + 4096]
            text = "".join([f"\x02{words[i]}\x03" for i in part])
            yield np.array(part), np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(len(part), width), t, weight


#: Cells of the direct table of triples; scripts with more characters look triples up in a sorted list.
DIRECT_CELLS = 1 << 23


class Kernel:
    """Cubed scaled kernel of words against fixed landmarks.

    Characters that no landmark has count as one. The landmarks' triples are
    numbered; triple ``r`` has entries ``starts[r]`` to ``starts[r + 1]``: which
    landmarks hold it and with what weight (number 0: none does).
    """

    def __init__(self, landmarks: list[str]):
        self.size = len(landmarks)
        self.letters = np.array(sorted({ord(c) for w in landmarks for c in w} | {2, 3}), np.int64)
        self.base = len(self.letters) + 1
        self._tables()
        cells: dict[int, dict[int, float]] = {}
        for which, chars, t, weight in _features(landmarks):
            for i, codes in zip(which.tolist(), self._codes(chars, t).tolist()):
                for c, x in zip(codes, weight.tolist()):
                    line = cells.setdefault(c, {})
                    line[i] = line.get(i, 0.0) + x
        self.codes = np.array(sorted(cells), np.int64)
        lines = [cells[c] for c in self.codes.tolist()]
        self.starts = np.cumsum([0, 0] + [len(x) for x in lines])
        self.which = np.array([i for x in lines for i in x], np.int64)
        self.value = np.array([v for x in lines for v in x.values()])
        self._tables()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("letter", "direct")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._tables()

    def _tables(self) -> None:
        """Tables that follow from the rest and are not sent along."""
        self.letter = np.zeros(0x110000, np.int64)
        self.letter[self.letters] = np.arange(1, self.base)
        self.direct = None
        if self.base ** 3 <= DIRECT_CELLS and hasattr(self, "codes"):
            self.direct = np.zeros(self.base ** 3, np.int32)
            self.direct[self.codes] = np.arange(1, len(self.codes) + 1)

    def _codes(self, chars: np.ndarray, t: np.ndarray) -> np.ndarray:
        x = self.letter[chars]
        return (x[:, t[:, 0]] * self.base + x[:, t[:, 1]]) * self.base + x[:, t[:, 2]]

    def _numbers(self, codes: np.ndarray) -> np.ndarray:
        """The number of each triple, 0 if no landmark has it."""
        if self.direct is not None:
            return self.direct[codes]
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at + 1, 0)

    def __call__(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.size), np.float32)
        for which, chars, t, weight in _features(words):
            numbers = self._numbers(self._codes(chars, t))
            word, col = np.nonzero(numbers)
            first = self.starts[numbers[word, col]]
            size = self.starts[numbers[word, col] + 1] - first
            at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
            cell = np.repeat(word * self.size, size) + self.which[at]
            out[which] = np.bincount(cell, np.repeat(weight[col], size) * self.value[at], len(which) * self.size).reshape(-1, self.size)
        return out ** POWER


def pieces(word: str) -> list[str]:
    if len(word) <= PIECE:
        return [word]
    return [word[i:i + PIECE] for i in range(0, len(word) - PIECE // 2, PIECE // 2)]


@dataclass
class Model:
    """``score(word)`` sums to a phrase's margin; the worst phrase's margin gives the document's probability."""

    kernel: Kernel
    alpha: np.ndarray
    bias: float
    slope: float
    offset: float

    def __post_init__(self):
        self._seen: dict[str, float] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_seen"}

    def __setstate__(self, state):
        self.__dict__.update(state, _seen={})

    def words(self, words: list[str]) -> list[float]:
        """Each word's part of the margin (a memory of past words only saves time)."""
        new = [w for w in dict.fromkeys(words) if w not in self._seen]
        if len(self._seen) + len(new) > 400_000:
            self._seen = {}
            new = list(dict.fromkeys(words))
        for a in range(0, len(new), 20_000):
            part = new[a:a + 20_000]
            cut = [pieces(w) for w in part]
            flat = [p for c in cut for p in c]
            values = self.kernel(flat) @ self.alpha
            ends = np.cumsum([len(c) for c in cut])
            self._seen.update(zip(part, np.maximum.reduceat(values, np.r_[0, ends[:-1]]).tolist()))
        return [self._seen[w] for w in words]

    def margins(self, texts: list[str]) -> np.ndarray:
        """The worst phrase of each text; the bias alone if it has no words."""
        parts = [phrases(t) for t in texts]
        flat = [p for d in parts for p in d]
        words = [w for p in flat for w in p]
        if not words:
            return np.full(len(texts), self.bias)
        g = np.array(self.words(words))
        sums = np.add.reduceat(g, np.cumsum([0] + [len(p) for p in flat])[:-1]) + self.bias
        out = np.full(len(texts), self.bias)
        at = 0
        for i, d in enumerate(parts):
            if d:
                out[i] = max(self.bias, sums[at:at + len(d)].max())
                at += len(d)
        return out

    def probability(self, texts: list[str]) -> np.ndarray:
        return _sigmoid(self.slope * self.margins(texts) + self.offset)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _landmarks(toxic: list[list[list[str]]], clean: list[list[list[str]]], n: int) -> tuple[list[str], dict[str, float]]:
    """Words of toxic documents that clean ones lack most, common words of clean ones, and all words' log odds."""
    count = [Counter(p for d in docs for p in {q for ph in d for w in ph for q in pieces(w)}) for docs in (toxic, clean)]
    odds = {w: np.log((c + 0.1) / (len(toxic) + 1)) - np.log((count[1][w] + 0.1) / (len(clean) + 1)) for w, c in count[0].items()}
    bad = sorted((w for w in odds if odds[w] > 0), key=lambda w: (-odds[w] * np.log1p(count[0][w]), w))[:n]
    good = sorted(count[1], key=lambda w: (-count[1][w], w))[:n]
    return list(dict.fromkeys([*bad, *good])), odds


def _svm(x: np.ndarray, y: np.ndarray, rounds: int = 30, rows: int = 8192) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by Newton steps on the active rows; rows with y = 0 are left out."""
    n, m = x.shape
    w = np.zeros(m + 1)
    reg = np.eye(m + 1)
    reg[-1, -1] = 1e-3
    for _ in range(rounds):
        gram, right = reg.copy(), np.zeros(m + 1)
        for a in range(0, n, rows):
            t = y[a:a + rows]
            active = (t != 0) & (t * (x[a:a + rows] @ w[:-1] + w[-1]) < 1)
            block = np.c_[x[a:a + rows][active], np.ones(active.sum())]
            gram += 2 * COST * block.T @ block
            right += 2 * COST * block.T @ t[active]
        new = np.linalg.solve(gram, right)
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def train(toxic: list[str], clean: list[str], landmarks: int = LANDMARKS) -> Model | None:
    """The machine of these labelled texts; None if a class is empty.

    A label holds for a whole text, so its sentences are labelled in turns: all of
    clean texts are clean; of a toxic text, those count as toxic that hold a word
    that toxic texts favour, then those that the machine itself takes for toxic
    (the worst one at least).
    """
    bad, good = ([phrases(t) for t in docs] for docs in (toxic, clean))
    if not any(bad) or not any(good):
        return None
    marks, odds = _landmarks(bad, good, landmarks)
    kernel = Kernel(marks)
    # whitening of the landmarks' kernel
    value, vector = np.linalg.eigh(kernel(marks).astype(float))
    keep = value > 1e-4 * value.max()
    white = (vector[:, keep] / np.sqrt(value[keep])).astype(np.float32)

    docs = [*bad, *good]
    words = sorted({p for d in docs for ph in d for w in ph for p in pieces(w)})
    number = {w: i for i, w in enumerate(words)}
    parts = np.concatenate([kernel(words[i:i + 10_000]) @ white for i in range(0, len(words), 10_000)])

    # a phrase is the sum of its words
    flat = [np.array([number[p] for w in ph for p in pieces(w)]) for d in docs for ph in d]
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    x = np.empty((len(flat), parts.shape[1]), np.float32)
    for a in range(0, len(flat), 8192):
        block = flat[a:a + 8192]
        x[a:a + 8192] = np.add.reduceat(parts[np.concatenate(block)], np.cumsum([0] + [len(p) for p in block])[:-1], axis=0)
    toxic_row = owner < len(bad)

    word_odds = np.array([odds.get(w, -9.0) for w in words])
    strength = np.array([word_odds[p].max() for p in flat])
    worst = np.full(len(docs), -np.inf)
    np.maximum.at(worst, owner, strength)
    positive = toxic_row & (strength >= worst[owner] - 1e-9) & (strength > 0)
    for _ in range(4):
        w, b = _svm(x, np.where(positive, 1.0, np.where(toxic_row, 0.0, -1.0)))
        margin = x @ w.astype(np.float32) + b
        worst = np.full(len(docs), b)
        np.maximum.at(worst, owner, margin)
        new = toxic_row & ((margin > 0) | (margin >= worst[owner]))
        if (new == positive).all():
            break
        positive = new
    slope, offset = _platt(worst, np.r_[np.ones(len(bad)), np.zeros(len(good))])
    return Model(kernel, (white @ w).astype(np.float32), b, slope, offset)


def _platt(m: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Logistic curve over the margins, slightly shrunk so that it stays finite."""
    x, w = np.c_[m, np.ones(len(m))], np.zeros(2)
    n1 = y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (len(y) - n1 + 2))
    reg = np.diag([1e-3, 1e-6])
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + reg, x.T @ (p - t) + reg @ w)
        size = np.abs(step).max()
        w = w - step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-9:
            break
    return float(w[0]), float(w[1])


def held_out(id_col) -> F.Column:
    """Rows that no label is learnt from: crc32 of the id as text, modulo 5, is 0 (a null id: false)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """Train on a bounded sample: of each class the ``sample`` ids with the smallest
    hash among the rows that are not held out and have a text of at most ``SAMPLE_BYTES``.

    Ids that are null, have a null label or contradicting labels are not used. None,
    with a warning, if a class has no usable text: then every score is 0.
    """
    one = (labels.where(labels[id_col].isNotNull() & labels[label_col].isNotNull())
           .select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("y"))
           .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z"))
    by = F.xxhash64("doc_id")
    text = docs.where(docs[text_col].isNotNull() & (F.octet_length(docs[text_col]) <= SAMPLE_BYTES)).select(
        docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    one = one.join(text.select("doc_id").distinct(), "doc_id", "left_semi")  # only ids with a text that can be used take a place
    ids = one.where("y = 1").orderBy(by, "doc_id").limit(sample).union(one.where("y = 0").orderBy(by, "doc_id").limit(sample)).select("doc_id", "y")
    rows = (text.join(F.broadcast(ids), "doc_id")          # at most 2 * sample ids
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")).orderBy("doc_id").collect())
    model = train([r["text"] for r in rows if r["y"] == 1], [r["text"] for r in rows if r["y"] == 0])
    if model is None:
        warnings.warn("no toxicity model: a class has no usable labelled text", stacklevel=2)
    return model


def score(spark: SparkSession, docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1; ``score_`` where another column has that name) in place of the text. Null and empty texts score
    as texts without any toxic phrase; without a model (a class had no labelled text) all score 0."""
    sent = spark.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c != text_col]
    name = fresh(docs.select(*[docs[f"`{c}`"] for c in others]), "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model | None = sent.value
        for b in blocks(batches, text_col, SCORE_BYTES):
            texts = [t or "" for t in b.column(text_col).to_pylist()]
            s = m.probability(texts) if m else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in others], pa.array(s, pa.float64())], names=[*others, name])

    from pyspark.sql.types import DoubleType, StructField, StructType
    return docs.mapInArrow(run, StructType([*[docs.schema[c] for c in others], StructField(name, DoubleType())]))


def reject(spark: SparkSession, docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score at least ``threshold``; the others unchanged.

    Null and empty texts score as texts without any toxic phrase and stay, as does
    every row if there is no model; repeated rows are judged alike; no rows give no rows.
    """
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model | None = sent.value
        for b in blocks(batches, text_col, SCORE_BYTES):
            if m is None:
                yield b
                continue
            s = m.probability([t or "" for t in b.column(text_col).to_pylist()])
            yield b.filter(pa.array(s < threshold))

    return docs.mapInArrow(run, docs.schema)
