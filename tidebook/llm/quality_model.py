"""Quality classifier: a weak-label model over heuristic labellers, then a hashed linear scorer on its posteriors.

Both are fitted on all texts.  One pass over the texts writes each one's vote pattern and hashed features; the
patterns, 3^7 at most, give the weak-label model, and the scorer is a logistic regression on its posteriors, whose
gradients are summed on the executors in every round.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.durable import materialize, release
from .common import Rows, sliced, tidied, word_bytes
from .quality_rules import SPACE, rule_counts

#: Buckets of the hashed scorer, rounds of its fit, weight of the squared norm in its loss, and steps it remembers.
BUCKETS, ROUNDS, RIDGE, MEMORY = 1 << 16, 20, 1e-5, 8
#: Buckets to a part when gradients are summed.
_PART = 1 << 11
GOOD, BAD, SILENT = 1, 0, 2
LABELLERS = ("symbols", "marked", "upper", "repeat", "variety", "word_length", "lines")
_CLASS = bytes(ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)


def votes(text: str | None) -> list[int]:
    """What each labeller says of a text: good, bad or nothing.  Short and empty texts get fewer votes."""
    text = text or ""
    n, chars, symbols, dup, repeat, upper, marked = rule_counts(text)
    if not n:
        return [BAD] + [SILENT] * 6
    kinds = len(set(word_bytes(text)))
    lines = max(1, text.count("\n") + 1)
    say = lambda x, good, bad: GOOD if x <= good else BAD if x >= bad else SILENT
    return [
        say(symbols / n, 0.02, 0.2),
        say(marked / n, 0.05, 0.3),
        say(upper / n, 0.1, 0.5),
        say(repeat / n, 0.05, 0.4) if n >= 10 else SILENT,
        say(-kinds / n, -0.4, -0.15) if n >= 20 else SILENT,
        say(abs(chars / n - 5.5), 3.0, 6.0),
        say(dup / lines, 0.1, 0.5) if lines >= 4 else SILENT,
    ]


def pattern(text: str | None) -> int:
    code = 0
    for v in votes(text):
        code = code * 3 + v
    return code


def unpack(codes: np.ndarray) -> np.ndarray:
    k = len(LABELLERS)
    return codes[:, None] // 3 ** np.arange(k - 1, -1, -1) % 3


@dataclass
class WeakLabels:
    """Prior of good, and for each class, labeller and vote its probability if it votes; silence says nothing."""

    prior: float
    says: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        k = np.arange(v.shape[1])
        log = [np.log(p) + np.where(v == SILENT, 0.0, np.log(self.says[y][k, v])).sum(1) for y, p in ((0, 1 - self.prior), (1, self.prior))]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def fit_weak_labels(v: np.ndarray, count: np.ndarray, rounds: int = 100) -> WeakLabels:
    """Expectation-maximisation over distinct vote patterns with their counts, from the share of bad votes.

    Labellers start better than chance, so that class 1 stays good; counts are smoothed, so that no vote is impossible."""
    good, bad = (v == GOOD).sum(1), (v == BAD).sum(1)
    p = (good + 1.0) / (good + 3 * bad + 2.0)
    p = np.where(bad >= 2, 0.1, np.where(bad == 1, np.minimum(p, 0.5), 0.95))
    model = WeakLabels(0.5, np.full((2, v.shape[1], 3), 1 / 3))
    for _ in range(rounds):
        w = np.stack([(1 - p) * count, p * count])
        says = np.stack([np.stack([(w[y][:, None] * (v == s)).sum(0) for s in (BAD, GOOD)], 1) + 1.0 for y in (0, 1)])
        says = np.concatenate([says / says.sum(2, keepdims=True), np.ones((2, v.shape[1], 1))], 2)
        model = WeakLabels(float((w[1].sum() + 1) / (count.sum() + 2)), says)
        new = model.posterior(v)
        if np.abs(new - p).max(initial=0.0) < 1e-7:
            break
        p = new
    return model


def hashed(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: shares of word shapes and of words like the one before, weighted up, and of words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    shapes = Counter(_RUN.sub(rb"\1", raw.translate(_CLASS)).split())
    words = raw.lower().split()
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    kinds = Counter(words)
    at = [xxhash.xxh3_64_intdigest(t, 1) for t in (b"again", *shapes)] + list(map(xxhash.xxh3_64_intdigest, kinds))
    value = np.array([8.0 * again, *(4.0 * c for c in shapes.values()), *kinds.values()])
    return np.array(at, np.uint64).astype(np.int64) & (BUCKETS - 1), value / max(1, len(words))


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], w: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Limited-memory quasi-Newton steps; ``f`` gives loss and gradient and is asked ``rounds`` times at most."""
    loss, g = f(w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    size, asked = 1.0 / max(1.0, float(np.linalg.norm(g))), 1
    while asked < rounds and np.abs(g).max(initial=0.0) > 1e-7:
        d, back = g.copy(), []
        for x, y in reversed(steps):
            a = (x @ d) / (x @ y)
            d -= a * y
            back.append(a)
        if steps:
            x, y = steps[-1]
            d *= (x @ y) / (y @ y)
        for (x, y), a in zip(steps, reversed(back), strict=True):
            d += (a - (y @ d) / (x @ y)) * x
        new, asked = w - size * d, asked + 1
        new_loss, new_g = f(new)
        if new_loss > loss - 1e-4 * size * (g @ d):
            size /= 4
            continue
        if (new - w) @ (new_g - g) > 1e-12:
            steps = [*steps[1 - MEMORY :], (new - w, new_g - g)]
        w, loss, g, size = new, new_loss, new_g, 1.0
    return w


def gradient(rows: Iterable[tuple[np.ndarray, np.ndarray, float, float]], w: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed weighted log loss and gradient over (buckets, values, soft label, weight), the intercept last."""
    loss, g = 0.0, np.zeros(len(w))
    for at, x, p, weight in rows:
        z = float(w[at] @ x + w[-1])
        loss += weight * (np.logaddexp(0.0, z) - p * z)
        d = weight * (1 / (1 + np.exp(-z)) - p) if z > -500 else -weight * p
        np.add.at(g, at, d * x)
        g[-1] += d
    return loss, g


def score(text: str | None, w: np.ndarray) -> float:
    at, x = hashed(text)
    return float(1 / (1 + np.exp(-np.clip(w[at] @ x.astype("<f4").astype(float) + w[-1], -500, 500))))


def prepare(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, pattern, n, buckets, amounts`` per row, written: the vote pattern, the words, and hashed features."""

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        for b in sliced(batches):
            texts = b.column(1).to_pylist()
            found = [hashed(t) for t in texts]
            own = [pa.array([pattern(t) for t in texts], pa.int32()), pa.array([bool(t and t.strip(SPACE)) for t in texts], pa.bool_())]
            own += [pa.array([at.astype("<u2").tobytes() for at, _ in found], pa.binary()), pa.array([x.astype("<f4").tobytes() for _, x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), *own], ["doc_id", "pattern", "filled", "buckets", "amounts"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return materialize(rows.mapInArrow(tidied(run), f"doc_id {kind}, pattern int, filled boolean, buckets binary, amounts binary"), "features")


def _flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row, bucket and amount of every feature of a batch of prepared rows."""
    at = np.frombuffer(b"".join(b.column("buckets").to_pylist()), "<u2").astype(np.int64)
    x = np.frombuffer(b"".join(b.column("amounts").to_pylist()), "<f4").astype(float)
    return np.repeat(np.arange(b.num_rows), pc.binary_length(b.column("buckets")).to_numpy(zero_copy_only=False) // 2), at, x


def fit_scorer(prepared: DataFrame, posterior: np.ndarray, codes: np.ndarray, count: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the logistic scorer over all prepared rows, the intercept last, on soft labels of equal class weight.

    ``posterior`` and ``count`` go with the vote patterns ``codes``.  In each round every task sums its rows' gradient,
    parts of which are added where they meet: what reaches the driver is one vector, however many rows there are.
    """
    total = count.sum()
    if not total:
        return np.zeros(BUCKETS + 1)
    soft = np.zeros(3 ** len(LABELLERS))
    soft[codes] = posterior
    share = float(np.clip((posterior * count).sum() / total, 0.02, 0.98))
    weight = (soft / share + (1 - soft) / (1 - share)) / total

    def ask(w: np.ndarray) -> tuple[float, np.ndarray]:
        def part(batches: Iterable[pa.RecordBatch]) -> Rows:
            loss, g = 0.0, np.zeros(BUCKETS + 1)
            for b in sliced(batches):
                row, at, x = _flat(b)
                code = b.column("pattern").to_numpy(zero_copy_only=False)
                p, own = soft[code], weight[code]
                z = np.bincount(row, w[at] * x, b.num_rows) + w[-1]
                loss += float((own * (np.logaddexp(0.0, z) - p * z)).sum())
                d = own * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - p)
                g[:-1] += np.bincount(at, d[row] * x, BUCKETS)
                g[-1] += d.sum()
            whole = np.append(g, loss)
            starts = range(0, len(whole), _PART)
            yield pa.RecordBatch.from_arrays([pa.array([*starts], pa.int32()), pa.array([whole[i : i + _PART].tobytes() for i in starts], pa.binary())], ["part", "sums"])

        def add(batches: Iterable[pa.RecordBatch]) -> Rows:
            sums: dict[int, np.ndarray] = {}
            for b in batches:
                for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    sums[i] = sums.get(i, 0.0) + np.frombuffer(x)
            yield pa.RecordBatch.from_arrays([pa.array([*sums], pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "sums"])

        kind = "part int, sums binary"
        got = prepared.select("pattern", "buckets", "amounts").mapInArrow(tidied(part), kind).repartition("part").mapInArrow(tidied(add), kind).collect()
        whole = np.concatenate([np.frombuffer(r["sums"]) for r in sorted(got)])
        return float(whole[-1] + RIDGE * (w @ w) / 2), whole[:-1] + RIDGE * w

    return minimise(ask, np.zeros(BUCKETS + 1), rounds)


def fit(prepared: DataFrame, rounds: int = ROUNDS) -> tuple[WeakLabels, np.ndarray]:
    """The weak-label model from the vote patterns of all rows, and the scorer under its posteriors."""
    seen = prepared.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").toPandas()
    codes, count = seen["pattern"].to_numpy(np.int64), seen["n"].to_numpy(float)
    weak = fit_weak_labels(unpack(codes), count)
    return weak, fit_scorer(prepared, weak.posterior(unpack(codes)), codes, count, rounds)


def accuracies(spark: SparkSession, weak: WeakLabels) -> DataFrame:
    """``labeller, says_good_of_good, says_bad_of_bad``: how often each labeller, if it speaks, is estimated to be right."""
    rows = [(name, float(weak.says[1][k, GOOD]), float(weak.says[0][k, BAD])) for k, name in enumerate(LABELLERS)]
    return spark.createDataFrame(rows, "labeller string, says_good_of_good double, says_bad_of_bad double")


def classify(df: DataFrame, text: str = "text", id_col: str = "doc_id", bar: float = 0.5, rounds: int = ROUNDS) -> DataFrame:
    """Per input row ``doc_id``, the scorer's ``score`` (its probability of good) and ``kept``.

    A text is kept if its score is at least ``bar``.  Null and empty texts have no words and are rejected.  Repeated
    rows each give a row; on an empty table nothing is fitted and nothing comes out; other columns play no part.
    """
    prepared = prepare(df, text, id_col)
    _, w = fit(prepared, rounds)

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        for b in sliced(batches):
            row, at, x = _flat(b)
            z = np.bincount(row, w[at] * x, b.num_rows) + w[-1]
            s = np.where(b.column("filled").to_numpy(zero_copy_only=False), 1 / (1 + np.exp(-np.clip(z, -500, 500))), 0.0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array(s >= bar)], ["doc_id", "score", "kept"])

    kind = prepared.schema["doc_id"].dataType.simpleString()
    return prepared.mapInArrow(tidied(run), f"doc_id {kind}, score double, kept boolean")


def keep_good(df: DataFrame, text: str = "text", id_col: str = "doc_id", bar: float = 0.5, rounds: int = ROUNDS) -> DataFrame:
    """The rows of ``df`` that :func:`classify` keeps, all columns as they are."""
    prepared = prepare(df, text, id_col)
    _, w = fit(prepared, rounds)
    release(prepared)
    at = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        for b in sliced(batches):
            texts = b.column(at).to_pylist()
            yield b.filter(pa.array([bool(t and t.strip(SPACE)) and score(t, w) >= bar for t in texts], pa.bool_()))

    return df.mapInArrow(tidied(run), df.schema)
