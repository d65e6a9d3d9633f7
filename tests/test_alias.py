"""Weighted choice from an alias table."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tradewind.functions import draws as D


@pytest.mark.parametrize("seed", range(8))
def test_table_gives_each_word_its_share(seed):
    draw = random.Random(seed)
    weights = [draw.choice([0, 1, 7, 1000, 10**6]) for _ in range(draw.randint(1, 40))] + [1]
    own, other = D.alias_table(weights)
    n, shares = len(weights), [Fraction(0)] * len(weights)
    for slot in range(n):
        shares[slot] += Fraction(own[slot], D.MODULUS * n)
        shares[other[slot]] += Fraction(D.MODULUS - own[slot], D.MODULUS * n)
    assert all(abs(s - Fraction(w, sum(weights))) <= Fraction(n, D.MODULUS) for s, w in zip(shares, weights))


def test_no_weights():
    for weights in ([0, 0], [-1, 2], []):
        with pytest.raises(ValueError):
            D.alias_table(weights)


def test_chi_square_over_a_million_draws(spark):
    weights = [5_000_000, 2_000_000, 1_500_000, 900_000, 500_000, 90_000, 9_999, 1, 0]
    words = [(f"w{i}", w) for i, w in enumerate(weights)]
    rows = D.positioned(spark.range(1, 1_000_001).select(F.col("id").alias("n")), "n", "o_clerk")
    got = {r.word: r["count"] for r in rows.select(D.alias_pick("o_clerk", words).alias("word")).groupBy("word").count().collect()}
    expected = {w: 10**6 * n / sum(weights) for w, n in words}
    assert sum(got.values()) == 10**6 and "w8" not in got
    likely = [w for w in expected if expected[w] >= 5]
    assert sum((got.get(w, 0) - expected[w]) ** 2 / expected[w] for w in likely) < 30   # six degrees of freedom
