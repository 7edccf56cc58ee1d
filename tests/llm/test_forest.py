"""The forest and the bar of the quality rules come from all labelled rows, however many."""

import random

import numpy as np

from tidebook.llm import quality_rules


def test_forest_and_bar_see_every_labelled_row(spark):
    rng = random.Random(5)
    words = [f"{'abcdefgh'[i % 8] * (1 + i % 9)}{i}" for i in range(400)]
    rows = []
    for i in range(21_000):
        bad = i % 29 == 0
        text = [rng.choice(words) + ("!" if bad and rng.random() < 0.6 else "") for _ in range(12)]
        rows.append((i, " ".join(x.upper() if bad and rng.random() < 0.5 else x for x in text), None if i % 997 == 5 else int(not bad)))
    rows += [rows[0], (None, rows[1][1], 1)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(d, q) for d, _, q in rows[:21_000]], "doc_id long, quality int")
    fit = [(t, q) for d, t, q in rows if d is not None and q is not None]
    counts = np.array([quality_rules.rule_counts(t) for t, _ in fit])
    passed = ~quality_rules.base_failed(counts)
    assert passed.sum() > 20_000
    rates, good = quality_rules.features(counts[passed]), np.array([q == 1 for _, q in fit])[passed]
    forest = quality_rules.Forest(rates)
    score = forest.score(rates)
    assert (forest.score(rates[::-1])[::-1] == score).all() and (quality_rules.Forest(rates[::-1]).score(rates) == score).all()
    bars = np.unique(score)
    kept = [(np.searchsorted(np.sort(score[~good]), b, "right"), -b) for b in bars if (score[good] <= b).sum() / good.sum() >= quality_rules.KEEP_GOOD]
    bar = -min(kept)[1]
    text = {d: t for d, t, _ in rows}
    got = quality_rules.judge(docs, labels).collect()
    assert len(got) == len(rows)
    c = np.array([quality_rules.rule_counts(text[r["doc_id"]]) for r in got])
    want = forest.score(quality_rules.features(c))
    assert (np.array([r["anomaly"] for r in got]) == want).all()
    assert [r["kept"] for r in got] == (~quality_rules.base_failed(c) & (want <= bar)).tolist()
    assert 0 < sum(not r["kept"] for r in got) < 3_000


def test_bar_of_few_rows(spark):
    def bar(rows):
        df = spark.createDataFrame([(s, int(np.float64(s).view(np.int64)), g) for s, g in rows], "score double, bits long, good boolean")
        return quality_rules.bar_of(df, 0.5)

    assert bar([]) == bar([(0.4, True)]) == bar([(0.4, False)]) == 1.0
    assert bar([(0.2, True), (0.3, True), (0.4, False), (0.1, False)]) == 0.3
    assert bar([(0.2, True), (0.3, True), (0.2, False), (0.9, False)]) == 0.3
    assert bar([(0.2, True), (0.3, True), (0.1, False)]) == 0.3
    assert bar([(0.2, False), (0.2, True), (0.2, True)]) == 0.2
