"""Document quality from lines: a linear-chain conditional random field.

Every line that has a word is good or bad.  What speaks for either are features of the line and
of its neighbours, and the state of the line before.  The forward-backward algorithm gives the
probability of each line being good; their mean, weighted by the lines' lengths, is the score of
the document.  Scores use the text alone.

Training.  The lines of a labelled document get its label.  The field is fitted to a sample: the
``TRAIN_DOCS`` labelled documents with the smallest hash of their id, and of each a run of
``TRAIN_LINES`` lines at most, which begins at a place taken from the same hash.  Both numbers
bound what the driver holds; they are the only limits here.  Features are made by the executors.
Without labelled documents, or with one label only, every document gets the same score.

Plan: one scan for the sample (its ids are broadcast) and one for the scores; no text is shuffled.

NULL is an empty text.  A text without words is one line with all features zero but the first.
Of several labels of an id the smallest counts; rows without an id or label are not learnt from.
"""

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

TRAIN_DOCS = 3000
TRAIN_LINES = 128
STEPS = 150
RATE = 0.1
DECAY = 1e-4  # of the weights, by the mean likelihood of a line
MOST = 30.0  # of a line's evidence, in logarithms

# Classes of characters.
LOWER, UPPER, DIGIT, SPACE, POINT, SYMBOL, OTHER = range(7)
SYMBOLS = "#*$%&|<>"
POINTS = ".,;:!?'\"()-"
SPACES = " \t\n\x0b\x0c\r"


def _classes() -> np.ndarray:
    table = np.full(1 << 16, OTHER, np.uint8)
    for code in range(1 << 16):
        c = chr(code)
        if c.islower():
            table[code] = LOWER
        elif c.isupper():
            table[code] = UPPER
        elif c.isdigit():
            table[code] = DIGIT
    for chars, kind in ((SPACES, SPACE), (POINTS, POINT), (SYMBOLS, SYMBOL)):
        table[[ord(c) for c in chars]] = kind
    return table


CLASSES = _classes()
OWN = 7 + 12  # features of a line


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Matrix of the features of each line that has a word, and the lengths of these lines."""
    lines = text.split("\n")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = CLASSES[np.minimum(codes, (1 << 16) - 1)]
    at = np.cumsum(codes == 10)
    counts = np.bincount(at * 7 + kinds, minlength=7 * len(lines)).reshape(-1, 7)
    counts[1:, SPACE] -= 1  # the line feed before the line
    kept, rows, seen = [], [], set()
    for i, line in enumerate(lines):
        words = line.split()
        if not words:
            continue
        n = len(words)
        kept.append(i)
        again = sum(map(eq, words, words[1:])) / n
        rows.append((n, len(set(words)) / n, again, line in seen, words[-1][-1] in ".!?", words[0][:1].isupper()))
        seen.add(line)
    if not kept:
        x = np.zeros((1, 3 * OWN - 2), np.float32)
        x[0, 0] = 1
        return x, np.ones(1)
    counts, rows = counts[kept].astype(np.float64), np.array(rows, np.float64)
    size = np.maximum(counts.sum(axis=1), 1)
    shares = counts / size[:, None]
    n, distinct, again, before, ended, capital = rows.T
    letters = np.maximum(counts[:, LOWER] + counts[:, UPPER], 1)
    upper = counts[:, UPPER] / letters
    own = np.column_stack([
        np.ones(len(size)), shares, np.log1p(size) / 8, size / n / 10, distinct, again, before, ended, capital, upper,
        shares[:, SYMBOL] > 0.02, again > 0.25, upper > 0.5,
    ])
    zero = np.zeros((1, OWN - 1))
    ahead = np.vstack([own[1:, 1:], zero])
    behind = np.vstack([zero, own[:-1, 1:]])
    return np.hstack([own, behind, ahead]).astype(np.float32), size


class Field:
    """Weights of the features for a good line, and of the steps from state to state (bad, good)."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray):
        self.weights, self.steps = weights, steps

    def marginals(self, x: np.ndarray) -> np.ndarray:
        """Probability of each line being good."""
        evidence = np.exp(np.clip(x @ self.weights, -MOST, MOST)).tolist()
        (bb, bg), (gb, gg) = np.exp(self.steps).tolist()
        forward, b, g = [], 1.0, 1.0
        for k, e in enumerate(evidence):
            if k:
                b, g = b * bb + g * gb, (b * bg + g * gg) * e
            else:
                g = e
            s = b + g
            b, g = b / s, g / s
            forward.append(g)
        out, b, g = [], 1.0, 1.0
        for k in range(len(evidence) - 1, -1, -1):
            f = forward[k]
            good, bad = f * g, (1 - f) * b
            out.append(good / (good + bad))
            e = evidence[k]
            b, g = bb * b + bg * e * g, gb * b + gg * e * g
            s = b + g
            b, g = b / s, g / s
        return np.array(out[::-1])

    def score(self, text: str) -> float:
        x, size = features(text)
        return float(np.average(self.marginals(x), weights=size))


def fit(runs: list[tuple[np.ndarray, int]]) -> Field:
    """The field of highest likelihood for runs of lines, each with one label (0 or 1)."""
    width = 3 * OWN - 2
    field = Field(np.zeros(width), np.zeros((2, 2)))
    if not runs:
        return field
    longest = max(len(x) for x, _ in runs)
    runs = sorted(runs, key=lambda run: -len(run[0]))
    size = np.array([len(x) for x, _ in runs])
    label = np.array([y for _, y in runs])
    x = np.zeros((len(runs), longest, width), np.float32)
    for i, (lines, _) in enumerate(runs):
        x[i, : len(lines)] = lines
    total = size.sum()
    held = np.arange(longest)[None, :] < size[:, None]
    first = x.reshape(-1, width)[held.ravel()]
    seen_steps = np.zeros((2, 2))
    for y in (0, 1):
        seen_steps[y, y] = (size[label == y] - 1).sum()
    seen_good = np.repeat(label, longest).reshape(-1, longest)[held]
    parts = [np.zeros(width), np.zeros((2, 2))]
    means, squares = [p.copy() for p in parts], [p.copy() for p in parts]
    for step in range(1, STEPS + 1):
        evidence = np.zeros(held.shape)
        evidence[held] = np.clip(first @ parts[0], -MOST, MOST)
        good, steps = _expected(np.exp(evidence), held, size, np.exp(parts[1]))
        gradients = [
            first.T @ (seen_good - good[held]) / total - DECAY * parts[0],
            (seen_steps - steps) / total - DECAY * parts[1],
        ]
        for i, g in enumerate(gradients):  # Adam
            means[i] = 0.9 * means[i] + 0.1 * g
            squares[i] = 0.999 * squares[i] + 0.001 * g * g
            parts[i] = parts[i] + RATE * (means[i] / (1 - 0.9**step)) / (np.sqrt(squares[i] / (1 - 0.999**step)) + 1e-8)
    return Field(parts[0], parts[1])


def _expected(evidence: np.ndarray, held: np.ndarray, size: np.ndarray, steps: np.ndarray):
    """Marginals of good lines, and expected numbers of steps, over runs sorted by length."""
    n, longest = evidence.shape
    forward = np.zeros((longest, n, 2))
    state = np.column_stack([np.ones(n), evidence[:, 0]])
    forward[0] = state / state.sum(axis=1, keepdims=True)
    for t in range(1, longest):
        m = int(held[:, t].sum())
        state = forward[t - 1, :m] @ steps
        state[:, 1] *= evidence[:m, t]
        forward[t, :m] = state / state.sum(axis=1, keepdims=True)
    back = np.ones((n, 2))
    good, taken = np.zeros(evidence.shape), np.zeros((2, 2))
    for t in range(longest - 1, -1, -1):
        m = int(held[:, t].sum())
        both = forward[t, :m] * back[:m]
        good[:m, t] = both[:, 1] / both.sum(axis=1)
        if t:
            ahead = back[:m].copy()
            ahead[:, 1] *= evidence[:m, t]
            pair = forward[t - 1, :m, :, None] * steps[None] * ahead[:, None, :]
            taken += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            state = ahead @ steps.T
            back[:m] = state / state.sum(axis=1, keepdims=True)
    return good, taken


def _sampled(most: int):
    """Function for mapInPandas: a run of ``most`` lines at most of each text."""

    def run(batches):
        for batch in batches:
            rows = []
            for key, text, label in zip(batch["key"], batch["text"], batch["label"]):
                x, _ = features(text or "")
                begin = int(key) % max(len(x) - most + 1, 1)
                lines = np.ascontiguousarray(x[begin : begin + most])
                rows.append((key, int(label), lines.astype("<f4").tobytes()))
            yield pd.DataFrame(rows, columns=["key", "label", "lines"])

    return run


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", quality: str = "quality") -> Field:
    """A field fitted to a bounded sample of the labelled documents."""
    labels = labels.where(F.col(doc_id).isNotNull() & F.col(quality).isin(0, 1))
    labels = labels.groupBy(F.col(doc_id).alias("id")).agg(F.min(quality).alias("label"))
    chosen = labels.withColumn("key", F.xxhash64("id").bitwiseAND(F.lit((1 << 62) - 1)))
    chosen = chosen.orderBy("key", "id").limit(TRAIN_DOCS)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    found = texts.join(F.broadcast(chosen), "id").select("key", "text", "label")  # TRAIN_DOCS rows at most
    found = found.mapInPandas(_sampled(TRAIN_LINES), "key bigint, label int, lines binary")
    rows = found.orderBy("key", "lines").limit(2 * TRAIN_DOCS).collect()
    return fit([(np.frombuffer(r["lines"], "<f4").reshape(-1, 3 * OWN - 2), r["label"]) for r in rows])


def scorer(field: Field):
    """Function of a text column that gives the score."""

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([field.score(t) for t in texts], dtype="float64")

    return lambda text: score(F.coalesce(text, F.lit("")))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))
