"""Results of the operators that SQL can't express, against plain versions written another way."""

import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tidebook.llm import bpe, ctw, ngram_join, quality_model, quality_rules, secret_scan
from tidebook.llm.queries import VOCABULARY

DATA = "/root/testdata/sf0.001"
PATH, PATTERN = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
LONG = " ".join(f"w{i % 977}" for i in range(20_000))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


class PlainTree:
    """Context-tree weighting by its recursion over counts, in exact fractions."""

    def __init__(self, order):
        self.order, self.n = order, defaultdict(lambda: [0, 0])

    def decisions(self, context, byte):
        for i in range(8):
            yield format(byte, "08b")[:i], (byte >> (7 - i)) & 1

    def learn(self, context, byte):
        for name, bit in self.decisions(context, byte):
            for d in range(self.order + 1):
                self.n[name, context[len(context) - d :]][bit] += 1

    def estimate(self, a, b):
        p = Fraction(1)
        for n, k in ((a, 0), (b, a)):
            for i in range(n):
                p *= Fraction(2 * i + 1, 2 * (k + i + 1))
        return p

    def weighted(self, name, context, plus=None):
        """The probability of all decisions seen at a node; ``plus``: one more there, as (context, bit)."""
        a, b = self.n.get((name, context), (0, 0))
        if plus and plus[0].endswith(context):
            a, b = a + (plus[1] == 0), b + plus[1]
        if not a + b:
            return Fraction(1)
        own = self.estimate(a, b)
        if len(context) == self.order:
            return own
        below = {c for k, c in self.n if k == name and len(c) == len(context) + 1 and c.endswith(context)}
        if plus and plus[0].endswith(context):
            below.add(plus[0][len(plus[0]) - len(context) - 1 :])
        return own / 2 + math.prod((self.weighted(name, c, plus) for c in below), start=Fraction(1)) / 2

    def log10(self, context, byte):
        total = 0.0
        for name, bit in self.decisions(context, byte):
            total += math.log10(self.weighted(name, b"", (context, bit)) / self.weighted(name, b""))
        return total


def test_ctw_score_is_the_recursion(spark):
    order, HELD = 2, next(d for d in range(10, 99) if zlib.crc32(str(d).encode()) % 7 == 2)  # noqa: N806
    texts = {3: "abracadabra", 4: "Abra cad", 5: "", 7: None, HELD: "abc abd", 9: "zebra é"}
    tree = PlainTree(order)
    raw = {d: (t or "").lower().encode() for d, t in texts.items()}
    held = {d for d in texts if zlib.crc32(str(d).encode()) % 7 == 2}
    assert held and held != set(texts)
    steps = {d: [((b"\xff" * order + t + b"\xff")[i : i + order], (t + b"\xff")[i]) for i in range(len(t) + 1)] for d, t in raw.items()}
    for d in set(texts) - held:
        for c, b in steps[d]:
            tree.learn(c, b)
    want = {d: sum(tree.log10(c, b) for c, b in steps[d]) for d in texts}
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    for bound in (10**6, 0):
        got = {r["doc_id"]: r["score"] for r in ctw.score(df, F.crc32(F.col("doc_id").cast("string")) % 7 == 2, order=order, broadcast_grams=bound).collect()}
        assert got.keys() == want.keys() and all(abs(got[d] - want[d]) < 1e-6 for d in want)


def test_keep_one_judges_rows(spark):
    a, b, c, d = "a b c d e f g", "one two three four five six seven", "red green blue white black pink grey", "mon tue wed thu fri sat sun day"
    rows = [(1, a, 0), (2, a, 0), (2, b, 0), (3, c, 0), (3, d, 0), (3, d, 0), (3, d, 1), (None, a, 0), (None, LONG, 0), (4, None, 0), (4, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone_id int").withColumn("again_id", F.lit(1)).withColumn("own_key", F.lit(2)).withColumn("gone_key", F.lit(3))
    kept = ngram_join.keep_one(df)
    want = sorted(map(str, [(1, a), (2, b), (3, c), (3, d), (None, LONG), (4, None), (4, "")]))
    first = sorted(map(str, kept.collect()))
    assert kept.columns == df.columns and sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == want
    assert first == sorted(map(str, ngram_join.keep_one(df.repartition(3, "text")).collect()))


# --- secrets ---------------------------------------------------------------------------------------------------------
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    "access": (r"(AKIA[A-Z0-9]+)", 20),
    "hex": (r"([0-9a-f]+)", 24),
}


def plain_base(text):
    found = []
    for place, (kind, (form, least)) in enumerate(BASE.items()):
        found += [(m.start(), place, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(form, text, re.A) if len(m[1]) >= least]
    return [x for _, _, x in sorted(found)]


def test_secret_base_and_spans_over_a_table(spark):
    from hashlib import sha256

    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = ["", None, "token=abcde token=abcdef", "API_KEY : 'x1y2z3'", "apikey=ſecret1 ſecret=abcdefg", "AKIA" + "A" * 16 + " xAKIA" + "B" * 15, "0a" * 11 + "0 " + "0a" * 12, LONG + " password=hunter2", "secretpasswordtoken==abcdef", "passwd=\n\"abcdef"]
    rng = random.Random(9)
    odd += [f"see {''.join(rng.choices(string.ascii_letters + string.digits, k=20 + i))} and {'ab' * i}_{i}" for i in range(20)]
    df = df.union(spark.createDataFrame([(100_000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    texts = {r[0]: r[1] or "" for r in df.collect()}
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    kinds, seen = [*BASE, "random"], 0
    for r in secret_scan.scan(df, PATH, PATTERN).collect():
        text, base = texts[r["doc_id"]], plain_base(texts[r["doc_id"]])
        assert r["base_sha256"] == sha256(",".join(base).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x.startswith(k) for x in base) for k in BASE]
        spans = r["spans"].split(",") if r["spans"] else []
        parts = [(int(a), kinds.index(k), int(b)) for k, a, b in (x.split(":") for x in spans)]
        assert parts == sorted(parts) and [x for x in spans if not x.startswith("random")] == base
        covered = {i for a, k, b in parts if k < 3 for i in range(a, b)}
        random_ = {x for x in spans if x.startswith("random")}
        # runs that no base span touches, by the ratio, with a slow look at each
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
            if covered.isdisjoint(range(m.start(), m.end())):
                digest = re.fullmatch(r"([0-9a-f]+|[0-9A-F]+)", m[0]) and len(m[0]) in (32, 40, 56, 64, 96, 128) or re.fullmatch(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}", m[0])
                low = len(m[0]) / len(encoding.encode_ordinary(m[0])) < secret_scan.RATIO
                assert (f"random:{m.start()}:{m.end()}" in random_) == (low and not digest and not secret_scan.is_identifier(m[0], encoding))
                seen += low
    assert seen > 5


def test_secret_precision_and_recall_on_planted_keys(docs):
    encoding, rng = secret_scan._encoding(PATH, PATTERN), random.Random(11)
    prose = [t for (t,) in docs.select("text").collect() if t and not secret_scan.scan_text(t, encoding)[1]][:100]
    shapes = [(string.ascii_letters + string.digits, 32), (string.ascii_letters + string.digits + "+/", 40), (string.ascii_letters, 24), (string.ascii_uppercase + string.digits, 26)]
    hit = 0
    for i, t in enumerate(prose):
        letters, n = shapes[i % 4]
        at, key = t.find(" ") + 1, "".join(rng.choices(letters, k=n))
        hit += (at, at + n, "random") in secret_scan.scan_text(t[:at] + key + " " + t[at:], encoding)[1]
    names = ["getUserAccountSettingsByIdentifier", "this_is_a_long_snake_case_name", "com/example/project/module/Helper", "internationalization_localization", "2024-01-01/2024-02-01/2024-03", "a-very-long-kebab-case-title-here", "DEFAULT_MAX_CONNECTIONS_PER_HOST", "https_//docs_example_com/reference/api"]
    wrong = sum(bool(secret_scan.scan_text(f"see {n} here", encoding)[1]) for n in names)
    assert hit / len(prose) >= 0.98 and wrong == 0


# --- quality classifier ----------------------------------------------------------------------------------------------
def test_expectation_maximisation_by_loops():
    rng = random.Random(5)
    rows = [tuple(rng.choice((0, 1, 1, 1, 2)) for _ in quality_model.LABELLERS) for _ in range(200)]
    count = Counter(rows)
    patterns = sorted(count)
    got = quality_model.fit_weak_labels(np.array(patterns), np.array([float(count[v]) for v in patterns]), rounds=5)
    p = {}
    for v in patterns:
        good, bad = v.count(1), v.count(0)
        p[v] = 0.1 if bad >= 2 else min((good + 1) / (good + 3 * bad + 2), 0.5) if bad == 1 else 0.95
    for _ in range(5):
        said = {(y, k, s): 1.0 + sum(count[v] * (p[v] if y else 1 - p[v]) for v in patterns if v[k] == s) for y in (0, 1) for k in range(7) for s in (0, 1)}
        says = {(y, k, s): n / (said[y, k, 0] + said[y, k, 1]) for (y, k, s), n in said.items()}
        prior = (sum(count[v] * p[v] for v in patterns) + 1) / (len(rows) + 2)
        for v in patterns:
            a, b = (q * math.prod(says[y, k, s] for k, s in enumerate(v) if s != 2) for y, q in ((1, prior), (0, 1 - prior)))
            p[v] = a / (a + b)
    assert abs(got.prior - prior) < 1e-9 and all(abs(got.says[y][k, s] - says[y, k, s]) < 1e-9 for y, k, s in says)
    assert np.allclose(got.posterior(np.array(patterns)), [p[v] for v in patterns])


def test_classifier_is_the_plain_fit_on_all_rows(spark, docs):
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, LONG), (9004, " \t\n"), (9004, " \t\n"), (None, "plain words of one short line")], "doc_id long, text string")
    df = docs.select("doc_id", "text").union(odd).withColumn("score", F.lit(1.0)).withColumn("pattern", F.lit("x"))
    rows = [r["text"] for r in df.collect()]
    codes = Counter(quality_model.pattern(t) for t in rows)
    names = sorted(codes)
    weak = quality_model.fit_weak_labels(quality_model.unpack(np.array(names)), np.array([float(codes[c]) for c in names]))
    p = dict(zip(names, weak.posterior(quality_model.unpack(np.array(names))), strict=True))
    share = min(max(sum(p[c] * n for c, n in codes.items()) / len(rows), 0.02), 0.98)
    own = []
    for t in rows:
        at, x = quality_model.hashed(t)
        q = p[quality_model.pattern(t)]
        own.append((at, x.astype("<f4").astype(float), q, (q / share + (1 - q) / (1 - share)) / len(rows)))

    def ask(w):
        loss, g = quality_model.gradient(own, w)
        return loss + quality_model.RIDGE * (w @ w) / 2, g + quality_model.RIDGE * w

    w = quality_model.minimise(ask, np.zeros(quality_model.BUCKETS + 1), 6)
    e = np.zeros(len(w))
    e[[own[0][0][0], -1]] = 1e-5
    assert abs((ask(w + e)[0] - ask(w - e)[0]) / 2 - ask(w)[1] @ e) < 1e-9
    want = Counter((t, round(quality_model.score(t, w), 6) if t and t.strip() else 0.0) for t in rows)
    by_id = defaultdict(list)
    for r in df.collect():
        by_id[r["doc_id"]].append(r["text"])
    got = Counter()
    for r in quality_model.classify(df, rounds=6).collect():
        got[by_id[r["doc_id"]].pop(), round(r["score"], 6)] += 1
    assert got == want
    table = quality_model.accuracies(spark, weak).collect()
    assert [r["labeller"] for r in table] == [*quality_model.LABELLERS] and all(0 < r["says_good_of_good"] < 1 for r in table)


# --- quality rules ---------------------------------------------------------------------------------------------------
def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, dup, seen = text.split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    inside = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def path_length(tree, row):
    depth = 0
    while not isinstance(tree, float):
        k, cut, a, b = tree
        tree, depth = (a if row[k] < cut else b), depth + 1
    return tree


def test_rule_counts_and_forest_over_a_table(spark, docs):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, LONG), (9004, "a\n\na\n \nb a\nb a"), (9004, "a\n\na\n \nb a\nb a"), (None, "x y z v w " * 3)], "doc_id long, text string")
    df = docs.select("doc_id", "text").union(odd).withColumn("good", F.lit(1)).withColumn("row_id", F.lit("r"))
    texts = defaultdict(list)
    for r in df.collect():
        texts[r["doc_id"]].append(r["text"])
    good = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    order = [r[0] for r in docs.join(labels, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").collect()]
    fit = np.array([quality_rules.rule_counts(texts[d][0]) for d in order])
    passed = ~quality_rules.base_failed(fit)
    forest = quality_rules.Forest(quality_rules.features(fit[passed]))
    scores = lambda c: 2 ** (-sum(path_length(t, c) for t in forest.trees) / len(forest.trees) / forest.expected(forest.rows))
    labelled = [(scores(x), good[d] == 1) for x, d in zip(quality_rules.features(fit[passed]), np.array(order)[passed], strict=True)]
    keep_good = lambda b: sum(s <= b for s, g in labelled if g) / sum(g for _, g in labelled)
    bars = [(sum(s <= b for s, g in labelled if not g), -b) for b in sorted({s for s, _ in labelled}) if keep_good(b) >= quality_rules.KEEP_GOOD]
    bar = -min(bars)[1]
    n = 0
    for r in quality_rules.judge(df, labels).collect():
        text = texts[r["doc_id"]].pop()
        want = plain_counts(text)
        assert tuple(r[1:6]) == want
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        score = scores(quality_rules.features(np.array([quality_rules.rule_counts(text)]))[0])
        assert r["base_failed"] == failed and abs(r["anomaly"] - score) < 1e-9 and r["kept"] == (not failed and r["anomaly"] <= bar + 1e-12)
        n += 1
    assert n == df.count() and not any(texts.values())


# --- pipeline --------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("rows", [
    [],
    [(1, "The old mill by the river still grinds corn for the whole village every autumn.", "en", "a", 1, 7), (1, "The old mill by the river still grinds corn for the whole village every autumn.", "en", "a", 1, 7), (2, None, None, None, None, None), (None, "We walked along the quiet shore until the evening light had gone from the hills.", "en", None, 3, 1), (3, "", "en", "b", 0, 2), (4, LONG, "en", "c", 4, 3), (5, LONG, None, "c", 5, 3)],
])
def test_pipeline_on_awkward_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, copy int").withColumn("gone_id", F.lit(1)).withColumn("taken", F.lit(2))
    docs = df
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == df.columns
        docs = spark.createDataFrame(docs.collect(), df.schema)
    done = pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert len(done) == docs.count() and (rows or not done)
    assert all(r["text"] for r in docs.collect())
