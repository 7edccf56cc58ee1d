"""Quality rules: counts of each text, and an isolation forest over them with a bar set on labelled rows; both from all of those."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.durable import materialize, release
from .common import Rows, sliced

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOL = re.compile(r"[#*$%&|<>]")
SPACE = " \t\n\v\f\r"
MARKS = frozenset(b"#*$%&|<>!")
#: Trees, the share of all rows (one in so many) down to which their nodes are split, and how often at most.
TREES, TREE_ROWS, DEPTH = 128, 256, 8
#: Share of labelled good rows that the bar keeps.
KEEP_GOOD = 0.99


def rule_counts(text: str | None) -> tuple[int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; then upper-case words and words ending in a symbol mark."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    dup, seen = 0, set()
    lines = text.split("\n")
    if len(lines) > 1:
        for line in lines:
            if line in seen:
                dup += 1
            elif line.strip(SPACE):
                seen.add(line)
    upper = sum([x.isupper() and len(x) > 1 for x in words])
    marked = sum([x[-1] in MARKS for x in words])
    return n, len(text) - sum(map(text.count, SPACE)), len(SYMBOL.findall(text)), dup, _repeated(words), upper, marked


def _repeated(words: list[bytes]) -> int:
    """Words inside windows of five that a text holds twice or more."""
    n = len(words)
    if n < 6:
        return 0
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    k = len(ids)
    w = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    code = w[: n - 4]
    for i in range(1, 5):
        if i > 1 and k**5 >= 1 << 63:  # else the five ids fit one integer
            code = np.unique(code, return_inverse=True)[1].reshape(-1)
        code = code * k + w[i : n - 4 + i]
    order = np.sort(code)
    same = order[1:] == order[:-1]
    if not same.any():
        return 0
    at = np.flatnonzero(np.isin(code, order[1:][same]))
    edge = np.zeros(n + 1, np.int64)
    edge[at] += 1
    edge[at + 5] -= 1
    return int((np.cumsum(edge)[:n] > 0).sum())


def features(c: np.ndarray) -> np.ndarray:
    """Rates that do not grow with a text's length, from rows of ``rule_counts``."""
    n = np.maximum(c[:, 0], 1)
    return np.stack([c[:, 1] / n, c[:, 2] / n, c[:, 4] / n, c[:, 5] / n, c[:, 6] / n], 1)


class Forest:
    """Trees of random splits, grown level by level on all rows; a row's score is 2^-(mean path / expected path), near 1
    for rows split off early.

    A split of a node lies between the least and the largest value of all rows that reach it.  A node is split until its
    share of the rows is 1 / ``rows``, or ``depth`` times; a leaf adds to its depth the path expected below it for that
    share of ``rows`` rows.  The draws belong to places in the trees, so that neither the order of rows nor what task holds
    them matters: :meth:`over` grows the same trees on the rows of a table, whose counts and bounds are all that it takes.
    """

    def __init__(self, data: np.ndarray, seed: int = 7, trees: int = TREES, rows: int = TREE_ROWS, depth: int = DEPTH):
        self._grow(lambda level: self.spans(data, level), len(data), seed, trees, rows, depth)

    @classmethod
    def over(cls, rates: DataFrame, seed: int = 7, trees: int = TREES, rows: int = TREE_ROWS, depth: int = DEPTH) -> Forest:
        """The forest of all rows of ``rates``, columns of doubles.  Per level every task sums up its rows by node, and what
        reaches the driver is a row per node, however many rows there are."""
        forest, k = cls.__new__(cls), len(rates.columns)
        low, high = [f"low_{i}" for i in range(k)], [f"high_{i}" for i in range(k)]

        def ask(level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            def part(batches: Iterable[pa.RecordBatch]) -> Rows:
                whole = forest._none(level, k)
                for b in batches:
                    n, a, z = forest.spans(np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], 1), level)
                    whole = whole[0] + n, np.minimum(whole[1], a), np.maximum(whole[2], z)
                tree, node = np.nonzero(whole[0])
                own = [pa.array(tree, pa.int32()), pa.array(node, pa.int32()), pa.array(whole[0][tree, node])]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(x[tree, node, i]) for x in whole[1:] for i in range(k))], ["tree", "node", "n", *low, *high])

            found = rates.mapInArrow(part, f"tree int, node int, n long, {', '.join(f'{c} double' for c in low + high)}")
            got = found.groupBy("tree", "node").agg(F.sum("n").alias("n"), *(F.min(c).alias(c) for c in low), *(F.max(c).alias(c) for c in high)).toPandas()
            whole = forest._none(level, k)
            for x, columns in zip(whole, (["n"], low, high), strict=True):
                x[got["tree"], got["node"]] = got[columns].to_numpy().reshape(-1, *x.shape[2:])
            return whole

        forest._grow(ask, rates.count(), seed, trees, rows, depth)
        return forest

    @staticmethod
    def expected(n: float) -> float:
        """The mean path in a tree of ``n`` rows; between one and two rows, shares of a row count as such."""
        return max(0.0, n - 1.0) if n <= 2 else max(1.0, 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n)

    def _grow(self, ask: Callable[[int], tuple[np.ndarray, np.ndarray, np.ndarray]], total: int, seed: int, trees: int, rows: int, depth: int) -> None:
        """``ask`` gives, by tree and node of a level, the rows there and the least and largest value of each column."""
        self.rows, self.depth = max(2, min(rows, total)), depth
        which, where = np.random.default_rng(seed).random((2, trees, 1 << depth))
        self.axis, self.cut = np.zeros((trees, 1 << depth), np.int64), np.full((trees, 1 << depth), np.inf)
        path = np.full((trees, 1), np.nan)  # of leaves, and of all below them
        for level in range(depth + 1 if total else 0):
            n, low, high = ask(level)
            open_ = high > low
            ways = open_.sum(2)
            leaf = np.isnan(path) & ((level == depth) | (ways == 0) | (n * self.rows <= total))
            path[leaf] = [level + self.expected(self.rows * x / total) for x in n[leaf].tolist()]
            if level == depth:
                break
            tree, node = np.nonzero(np.isnan(path))
            at = node + (1 << level)
            pick = (which[tree, at] * ways[tree, node]).astype(np.int64)
            axis = (open_[tree, node].cumsum(1) > pick[:, None]).argmax(1)
            bottom, top = low[tree, node, axis], high[tree, node, axis]
            self.axis[tree, at], self.cut[tree, at] = axis, top - where[tree, at] * (top - bottom)
            path = np.repeat(path, 2, 1)
        self.path = path

    def _none(self, level: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = len(self.axis), 1 << level
        return np.zeros(shape, np.int64), np.full((*shape, k), np.inf), np.full((*shape, k), -np.inf)

    def _reached(self, tree: int, x: np.ndarray, level: int) -> np.ndarray:
        """The node of a level that each row reaches; what has met a leaf goes on to the left."""
        node, row = np.ones(len(x), np.int64), np.arange(len(x))
        for _ in range(level):
            node = 2 * node + (x[row, self.axis[tree][node]] >= self.cut[tree][node])
        return node - (1 << level)

    def spans(self, x: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, low, high = self._none(level, x.shape[1])
        for tree in range(len(n)) if len(x) else ():
            node = self._reached(tree, x, level).astype(np.uint16)
            order = np.argsort(node, kind="stable")
            node, own = node[order], x[order]
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            at = node[first]
            n[tree, at] = np.diff(np.append(first, len(x)))
            low[tree, at], high[tree, at] = np.minimum.reduceat(own, first, 0), np.maximum.reduceat(own, first, 0)
        return n, low, high

    @property
    def trees(self) -> list:
        """Each tree by itself: the path of a leaf, or the column and value of a split and the trees below and from it."""

        def nest(tree: int, level: int, at: int):
            if level == self.depth or self.cut[tree, at] == np.inf:
                return float(self.path[tree, (at << (self.depth - level)) - (1 << self.depth)])
            return int(self.axis[tree, at]), float(self.cut[tree, at]), nest(tree, level + 1, 2 * at), nest(tree, level + 1, 2 * at + 1)

        return [nest(t, 0, 1) for t in range(len(self.axis))] if self.path.shape[1] > 1 else []

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.path.shape[1] == 1 or not len(x):
            return np.zeros(len(x))
        total = np.zeros(len(x))
        for tree in range(len(self.axis)):
            total += self.path[tree, self._reached(tree, x, self.depth)]
        return 2.0 ** (-total / len(self.axis) / self.expected(self.rows))


def base_failed(c: np.ndarray) -> np.ndarray:
    return (c[:, 0] < 10) | (100 * c[:, 4] > 20 * c[:, 0])


def bar_of(scored: DataFrame, keep: float = KEEP_GOOD) -> float:
    """The score above which a row is rejected: the best balanced split of good and bad labelled rows among
    bars that keep the share ``keep`` of the good.  Without both kinds of label nothing is rejected.

    ``scored`` has ``score``, from 0 up, its ``bits`` as a long, in the same order, and ``good``.  The least bar allowed is
    the score of one of the good rows; it is found by counts of all rows, 16 bits at a time.  From there the bar
    moves up to the last score before the next bad row's.
    """
    n = dict(scored.groupBy("good").count().collect())
    if not n.get(True) or not n.get(False):
        return 1.0
    left = math.ceil(keep * n[True])
    left += left / n[True] < keep
    left -= (left - 1) / n[True] >= keep
    bits = 0
    for shift in (48, 32, 16, 0):
        own = scored.where("good") if shift == 48 else scored.where(F.col("good") & (F.shiftright("bits", shift + 16) == bits))
        for bits, held in sorted(map(tuple, own.groupBy(F.shiftright("bits", shift)).count().collect())):
            if held >= left:
                break
            left -= held
    least = float(np.int64(bits).view(np.float64))
    bad = scored.where(~F.col("good") & (F.col("score") > least)).agg(F.min("score")).first()[0]
    return scored.where(F.col("score") < bad if bad is not None else F.lit(True)).agg(F.max("score")).first()[0]


_COUNTS = "row_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_marked long"
_NAMES = [x.split()[0] for x in _COUNTS.split(", ")]


def _counts(batches: Iterable[pa.RecordBatch]) -> Rows:
    for b in sliced(batches):
        rows = np.array([rule_counts(t) for t in b.column(1).to_pylist()], np.int64).reshape(-1, 7)
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(rows[:, i]) for i in range(7))], _NAMES)


def count(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(f"`{id_col}`").alias("row_id"), F.col(f"`{text}`").alias("text")).mapInArrow(_counts, _COUNTS.format(kind=kind))


def _table(b: pa.RecordBatch, first: int) -> np.ndarray:
    """The seven counts of each row, from column ``first`` on."""
    return np.stack([b.column(first + i).to_numpy(zero_copy_only=False) for i in range(7)], 1) if b.num_rows else np.zeros((0, 7), np.int64)


_RATES = [f"rate_{i}" for i in range(5)]


def _labelled(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """``good`` and the rates of every labelled row that passes the base rules, written."""
    own = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.max("quality") == 1).alias("good"))

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        for b in batches:
            c = _table(b, 1)
            rates = features(c)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(rates[:, i]) for i in range(5))], ["good", *_RATES]).filter(pa.array(~base_failed(c)))

    found = counts.withColumnRenamed("row_id", "doc_id").join(own, "doc_id").select("good", *_NAMES[1:])
    return materialize(found.mapInArrow(run, f"good boolean, {', '.join(f'{c} double' for c in _RATES)}"), "labelled")


def _scored(labelled: DataFrame, forest: Forest) -> DataFrame:
    """``good``, ``score`` and its ``bits`` of all labelled rows, written."""

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        for b in batches:
            score = forest.score(np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[1:]], 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array(score.view(np.int64))], ["good", "score", "bits"])

    return materialize(labelled.mapInArrow(run, "good boolean, score double, bits long"), "scored")


def judge(df: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per input row: ``doc_id``, the five counts, ``base_failed``, ``anomaly`` and ``kept``.

    The forest grows on the rates of all labelled rows that pass the base rules, and the bar is set on the labels of all
    of them; nothing is sampled.  Texts are read once, for their counts, which are written.  Every row of the table is then scored.
    Null and empty texts have no words and so fail; with no labels only the base rules reject; repeated rows each give a row;
    other columns play no part.
    """
    counts = materialize(count(df, text, id_col), "counts")
    labelled = _labelled(counts, labels)
    forest = Forest.over(labelled.select(*_RATES))
    scored = _scored(labelled, forest)
    bar = bar_of(scored)
    release(labelled, scored)

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        for b in batches:
            c = _table(b, 1)
            score, failed = forest.score(features(c)), base_failed(c)
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(failed), pa.array(score), pa.array(~failed & (score <= bar))], ["doc_id", *STATS, "base_failed", "anomaly", "kept"])

    kind = df.schema[id_col].dataType.simpleString()
    return counts.mapInArrow(run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, anomaly double, kept boolean")
