"""Trees per key against a plain recursive tree."""

import math
import random

from corvid.ml import keyed_trees as kt

FEATURES = ["x", "y"]


def plain_tree(rows, depth, bins):
    """rows: (features, label); returns a function features -> mean."""
    known = [[r[0][i] for r in rows if r[0][i] is not None and not math.isnan(r[0][i])] for i in range(len(FEATURES))]
    lo, hi = [min(k, default=None) for k in known], [max(k, default=None) for k in known]

    def bin_of(x, i):
        if x is None or math.isnan(x) or lo[i] is None or hi[i] <= lo[i]:
            return 0
        return min(bins - 1, max(0, math.floor((x - lo[i]) / (hi[i] - lo[i]) * bins)))

    def build(part, level):
        mean = sum(y for _, y in part) / len(part)
        best = None
        if level < depth:
            for i in range(len(FEATURES)):
                for b in sorted({bin_of(f[i], i) for f, _ in part}):
                    left = [y for f, y in part if bin_of(f[i], i) <= b]
                    right = [y for f, y in part if bin_of(f[i], i) > b]
                    if not left or not right:
                        continue
                    s = sum(left) + sum(right)
                    gain = sum(left) * sum(left) / len(left) + sum(right) * sum(right) / len(right) - s * s / len(part)
                    if gain > kt.MIN_GAIN and (best is None or gain > best[0]):
                        best = (gain, i, b)
        if best is None:
            return lambda f: mean
        _, i, b = best
        low = build([r for r in part if bin_of(r[0][i], i) <= b], level + 1)
        high = build([r for r in part if bin_of(r[0][i], i) > b], level + 1)
        return lambda f: low(f) if bin_of(f[i], i) <= b else high(f)

    return build(rows, 0)


def test_equals_a_plain_tree_per_key(spark):
    rng = random.Random(3)
    rows = []
    for k in ["a", "b", "c", None, "one"]:
        for _ in range(1 if k == "one" else 60):
            x = rng.choice([None, float("nan"), *[float(v) for v in range(12)]])
            y = float(rng.randrange(5))
            rows.append((k, x, y, float(rng.randrange(20)) if rng.random() < 0.95 else None))
    rows.append(("unlabelled", 1.0, 2.0, None))
    df = spark.createDataFrame(rows, "k string, x double, y double, label double").repartition(4)
    trees = kt.grow(df, "k", "label", FEATURES, depth=3, bins=8)
    got = sorted((tuple(r) for r in kt.predict(trees, df, "k", FEATURES, depth=3, bins=8).collect()), key=repr)
    want = []
    for k in {r[0] for r in rows}:
        part = [((x, y), label) for key, x, y, label in rows if key == k and label is not None]
        tree = plain_tree(part, 3, 8) if part and k is not None else None
        want += [(*r, tree((r[1], r[2])) if tree else None) for r in rows if r[0] == k]
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=repr)):
        assert repr(a[:4]) == repr(b[:4])
        assert (a[4] is None) == (b[4] is None) and (a[4] is None or abs(a[4] - b[4]) < 1e-9)


def test_empty_table_and_no_split(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0, 5.0), ("a", 1.0, 1.0, 7.0)], "k string, x double, y double, label double")
    trees = kt.grow(df, "k", "label", FEATURES, depth=2)
    assert [r["prediction"] for r in kt.predict(trees, df, "k", FEATURES, depth=2).collect()] == [6.0, 6.0]
    assert kt.grow(df.limit(0), "k", "label", FEATURES).count() == 0
