"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, giving_back, map_texts

#: Documents that a fit takes at most, the lines and characters of the longest that it takes, and lines in all.
FIT_DOCS = 3000
FIT_LINES = 256
FIT_CHARS = 32_768
FIT_TOTAL = 90_000

#: Classes of bytes whose shares describe a line.
CLASSES = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t", ".,;:?'\"-()", "!", "|", "#$%&*+/<=>@[\\]^_`{}~"]


def _class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES), dtype=np.uint8)
    table[:32] = len(CLASSES) + 1
    for k, chars in enumerate(CLASSES):
        table[np.frombuffer(chars.encode(), dtype=np.uint8)] = k
    return table


TABLE = _class_table()
OWN = len(CLASSES) + 2 + 6  # shares, then word and repetition features
WIDTH = 1 + 3 * OWN
#: Characters of lines that are described at a time, and bytes of texts that are scored at a time.
LOT = 1 << 19
SCORED = 2 << 20
_SPACE = re.compile(r"\s")


def split_lines(text: str | None) -> list[str]:
    """Lines of a text, whole; null and empty texts have one empty line."""
    return (text or "").split("\n")


def _word_counts(line: str) -> tuple[int, int, int]:
    """Words, distinct words, and words like the one before. Long lines are split into words piece by piece."""
    if len(line) <= LOT:
        w = line.split()
        return len(w), len(set(w)), sum(map(eq, w, w[1:]))
    n, repeats, seen, last, at = 0, 0, set(), [], 0
    while at < len(line):
        space = _SPACE.search(line, at + LOT)
        end = space.start() if space else len(line)
        w = last + line[at:end].split()
        n += len(w) - len(last)
        repeats += sum(map(eq, w, w[1:]))
        seen.update(w)
        last, at = w[-1:], end
    return n, len(seen), repeats


def _lots(lines: list[str]) -> Iterator[slice]:
    """Runs of lines of about LOT characters, a line end counted as one."""
    ends = np.cumsum([len(x) + 1 for x in lines])
    start = 0
    while start < len(lines):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + LOT, side="right")))
        yield slice(start, stop)
        start = stop


def _lot_features(lines: list[str], repeated: list[bool]) -> np.ndarray:
    """(lines, OWN) of some lines; `repeated`: does the line's document hold it more than once?"""
    raw = [x.encode("utf-8") for x in lines]
    sizes = np.array([len(r) for r in raw])
    codes = TABLE[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.zeros((len(lines), OWN))
    n = len(CLASSES) + 2
    for k in range(n):
        total = np.zeros(len(codes) + 1, np.int32 if len(codes) < 1 << 31 else np.int64)
        np.cumsum(codes == k, out=total[1:])
        out[:, k] = np.sqrt((total[ends] - total[starts]) / np.maximum(sizes, 1))
    words, distinct, repeats = np.array([_word_counts(x) for x in lines]).T
    many = np.maximum(words, 1)
    out[:, n] = np.log1p(sizes) / 6
    out[:, n + 1] = np.log1p(sizes / many) / 3
    out[:, n + 2] = distinct / many
    out[:, n + 3] = repeats / many
    out[:, n + 4] = repeated
    out[:, n + 5] = sizes < 20
    return out


def own_features(docs: list[list[str]]) -> Iterator[np.ndarray]:
    """(lines, OWN) for the lines of all documents, one below the other, in lots."""
    lines = [x for d in docs for x in d]
    seen = [Counter(d) for d in docs]
    repeated = [seen[k][x] > 1 for k, d in enumerate(docs) for x in d]
    for lot in _lots(lines):
        yield _lot_features(lines[lot], repeated[lot])


def _neighbours(of_before: np.ndarray, of_after: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the line before and of the line after; zero where a document has none."""
    ends = np.cumsum(lengths)
    before, after = np.roll(of_before, 1, axis=0), np.roll(of_after, -1, axis=0)
    before[ends - lengths] = 0
    after[ends - 1] = 0
    return before, after


def line_features(docs: list[list[str]]) -> np.ndarray:
    """(lines, WIDTH): a constant, the line's own features and those of the lines before and after it."""
    own = np.concatenate(list(own_features(docs)))
    before, after = _neighbours(own, own, np.array([len(d) for d in docs]))
    return np.hstack([np.ones((len(own), 1)), own, before, after])


def line_values(docs: list[list[str]], weights: np.ndarray) -> np.ndarray:
    """`line_features(docs) @ weights`, of which three numbers a line are held and not the features."""
    parts = weights[1:].reshape(3, OWN).T
    seen = np.concatenate([own @ parts for own in own_features(docs)])
    before, after = _neighbours(seen[:, 1], seen[:, 2], np.array([len(d) for d in docs]))
    return weights[0] + seen[:, 0] + before + after


def _padded(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents by falling length, and how many of them have a line at each position."""
    order = np.argsort(-lengths, kind="stable")
    return order, np.searchsorted(-lengths[order], -np.arange(1, lengths.max() + 1), side="right")


def marginals(scores: np.ndarray, trans: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward for all documents at once, in logarithms.

    scores: (lines, 2); trans: (2, 2). Returns log Z per document, the marginals per line, and the expected
    transitions summed over all documents.
    """
    starts = np.cumsum(lengths) - lengths
    order, active = _padded(lengths)
    begin = starts[order]
    steps = len(active)
    alpha = np.empty_like(scores)
    beta = np.zeros_like(scores)
    alpha[begin] = scores[begin]
    for t in range(1, steps):
        at = begin[: active[t]] + t
        a = alpha[at - 1]
        alpha[at] = np.stack([np.logaddexp(a[:, 0] + trans[0, k], a[:, 1] + trans[1, k]) for k in (0, 1)], axis=1) + scores[at]
    expected = np.zeros((2, 2))
    for t in range(steps - 1, 0, -1):
        at = begin[: active[t]] + t
        b = beta[at] + scores[at]
        beta[at - 1] = np.stack([np.logaddexp(trans[k, 0] + b[:, 0], trans[k, 1] + b[:, 1]) for k in (0, 1)], axis=1)
    joint = alpha + beta
    line_z = np.logaddexp(joint[:, 0], joint[:, 1])
    inner = np.ones(len(scores), dtype=bool)
    inner[starts] = False
    at = np.nonzero(inner)[0]
    for j in (0, 1):
        for k in (0, 1):
            expected[j, k] = np.exp(alpha[at - 1, j] + trans[j, k] + scores[at, k] + beta[at, k] - line_z[at]).sum()
    return line_z[starts], np.exp(joint - line_z[:, None]), expected


@dataclass
class LineField:
    """Weights of the field, and the curve from a document's mean marginal to its score."""

    weights: np.ndarray
    trans: np.ndarray
    slope: float
    offset: float

    def good_lines(self, docs: list[list[str]]) -> np.ndarray:
        """Probability that each line is good."""
        lengths = np.array([len(d) for d in docs])
        values = line_values(docs, self.weights)
        return marginals(np.stack([np.zeros_like(values), values], axis=1), self.trans, lengths)[1][:, 1]

    def means(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Of each document, weighted by the length of the lines: mean probability, and share of lines over 0.5."""
        good = self.good_lines(docs)
        lengths = np.array([len(d) for d in docs])
        sizes = np.array([len(x) + 1 for d in docs for x in d], dtype=float)
        starts = np.cumsum(lengths) - lengths
        weight = np.add.reduceat(sizes, starts)
        return np.add.reduceat(good * sizes, starts) / weight, np.add.reduceat((good > 0.5) * sizes, starts) / weight

    def score(self, mean: np.ndarray) -> np.ndarray:
        """A mean probability on the scale of the labels."""
        return 1 / (1 + np.exp(-(self.slope * _logit(mean) + self.offset)))


def _logit(mean: np.ndarray) -> np.ndarray:
    return np.log((mean + 1e-4) / (1 - mean + 1e-4))


def _curve(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Logistic curve by Newton steps with a small penalty."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + 1e-2 * (w - [1.0, 0.0])
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2), grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def fit_field(docs: list[list[str]], labels: Sequence[int], rounds: int = 150, rate: float = 0.05, penalty: float = 1e-3) -> LineField:
    """Conditional likelihood of the lines' labels, which are those of their documents, by gradient steps with
    momentum. With no documents, or labels of one kind, the field is flat and the score is the share of label 1."""
    y = np.asarray(labels, dtype=float)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return LineField(np.zeros(WIDTH), np.zeros((2, 2)), 1e-3, float(np.log(share / (1 - share))))
    x = line_features(docs)
    lengths = np.array([len(d) for d in docs])
    line_y = np.repeat(y, lengths)
    importance = np.repeat(1 / lengths, lengths)[:, None]  # every document weighs the same in the emissions' penalty
    scale = np.maximum(np.sqrt((x * x * importance).sum(axis=0) / importance.sum()), 0.05)
    x = x / scale
    seen = np.zeros((2, 2))
    for k in (0, 1):
        seen[k, k] = (lengths[y == k] - 1).sum()
    theta, m, v = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
    for r in range(1, rounds + 1):
        w, trans = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
        values = x @ w
        _, p, expected = marginals(np.stack([np.zeros_like(values), values], axis=1), trans, lengths)
        grad = np.concatenate([x.T @ (line_y - p[:, 1]), (seen - expected).ravel()]) / len(line_y) - penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + rate * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    field = LineField(theta[:WIDTH] / scale, theta[WIDTH:].reshape(2, 2).copy(), 1.0, 0.0)
    field.slope, field.offset = _curve(_logit(field.means(docs)[0]), y)
    return field


def fold_of(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(f"`{id_col}`").cast("string")) % 4


def train(docs: DataFrame, labels: DataFrame, held_out: int = 2, most: int = FIT_DOCS, id_col: str = "doc_id", text: str = "text") -> LineField:
    """Fits on at most `most` labelled documents of the other folds, drawn by a hash of their id; documents of over
    FIT_LINES lines or FIT_CHARS characters, and those beyond FIT_TOTAL lines in all, are scored but not learned from.
    Only this bounded sample reaches the driver. A document with labels of both kinds counts as good, and of rows that
    repeat an id one is taken."""
    known = labels.filter(F.col("quality").isNotNull() & (fold_of(id_col) != held_out)).groupBy(id_col).agg(F.max("quality").alias("quality"))
    drawn = known.orderBy(F.xxhash64(id_col), id_col).limit(most)
    rows = docs.select(id_col, text).join(F.broadcast(drawn), id_col)  # at most `most` pairs of numbers
    lines = F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
    rows = rows.filter((lines <= FIT_LINES) & (F.coalesce(F.length(text), F.lit(0)) <= FIT_CHARS)).dropDuplicates([id_col])
    got = rows.select(id_col, text, "quality").orderBy(F.xxhash64(id_col), id_col).limit(most).collect()
    cut = [split_lines(r[text]) for r in got]
    n = int(np.searchsorted(np.cumsum([len(d) for d in cut]), FIT_TOTAL, side="right"))
    return fit_field(cut[:n], [int(r["quality"]) for r in got[:n]])


def score_docs(docs: DataFrame, field: LineField, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep` columns with `score` (0 to 1; higher: good) and `good_share` (length-weighted share of lines over 0.5).

    Null and empty texts are one empty line and get the score of such a line. Very long texts and lines are scored
    whole. Rows are scored one by one, whatever their id; a kept column named like a result gives way; an empty table gives an empty one.
    """

    def work(texts: list) -> list:
        mean, share = field.means([split_lines(t) for t in texts])
        return [pa.array(field.score(mean)), pa.array(share)]

    return map_texts(docs, work, "score double, good_share double", keep, text, most=SCORED)


def keep_good(docs: DataFrame, field: LineField, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The rows whose score reaches the threshold, as they were. The texts, a string column, go to the workers once, and
    only the rows that stay come back."""
    names, at = docs.columns, docs.columns.index(text)
    # Numbered names: Spark cannot pass columns whose names hold a dot to mapInArrow.
    rows = docs.select(*[F.col(f"`{c}`").alias(f"__{k}") for k, c in enumerate(names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, at, SCORED):
                mean, _ = field.means([split_lines(t) for t in part.column(at).to_pylist()])
                yield part.filter(pa.array(field.score(mean) >= threshold))

    return rows.mapInArrow(giving_back(run), rows.schema).select(*[F.col(f"__{k}").alias(c) for k, c in enumerate(names)])
