"""Operator 5: the miss rate follows ``percent``, and signature distance drops no pair."""

import random

import numpy as np
import pytest

from gleanspark.llm import near_dedup as N
from gleanspark.llm.shingles import odd_constants, shingle_sets


def pairs(rnd, changed):
    """Two texts of 45 shingles, the last ``changed`` replaced: (45 - c) / (45 + c) similar."""
    words = [f"w{rnd.getrandbits(60)}" for _ in range(49)]
    return " ".join(words), " ".join(words[:49 - changed] + [f"v{rnd.getrandbits(60)}" for _ in range(changed)])


def linked(spark, texts, percent):
    rows = [(2 * k + j, t) for k, two in enumerate(texts) for j, t in enumerate(two)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in N.near_dedup(df, percent=percent).collect()}
    return [got[2 * k] == got[2 * k + 1] for k in range(len(texts))]


def test_miss_rate_is_bounded_at_every_threshold():
    for percent in range(1, 101):
        symbols, chunks, errors = N.plan(percent)
        assert symbols % chunks == 0 and N.miss(percent, symbols, chunks, errors) <= N.MISS
    assert N.plan(80) == N.plan(85) == (60, 12, 1) and N.plan(50, 60, 12, 1) == (60, 12, 1)


def test_similar_pairs_beyond_the_signature_distance_are_linked(spark):
    rnd, salts, mults = random.Random(4), odd_constants(60, 1), odd_constants(60, 2)
    far = []
    for _ in range(60_000):
        two = pairs(rnd, 5)                              # exactly 80 percent
        a, b = (N.signature(h, salts, mults) for h in shingle_sets(list(two), 5))
        if (a != b).sum() > 23:
            far.append(two)
        if len(far) == 3:
            break
    assert len(far) == 3 and all(linked(spark, far, 80))


@pytest.mark.parametrize("percent, changed", [(60, 11), (40, 19), (10, 36)])
def test_low_thresholds_lose_no_pair(spark, percent, changed):
    rnd = random.Random(percent)
    assert all(linked(spark, [pairs(rnd, changed) for _ in range(40)], percent))
    assert np.mean(linked(spark, [pairs(rnd, changed + 2) for _ in range(10)], percent)) == 0


def test_long_texts_give_the_same_shingles():
    """Long data is hashed in pieces: any cut at blanks gives the words of the whole."""
    import random

    import numpy as np

    from gleanspark.llm import shingles

    rnd = random.Random(6)
    text = " ".join(rnd.choice("abcXYZé") * rnd.randint(1, 9) for _ in range(400_000)) + " " + "x" * 600_000 + " y\n z"
    data = np.frombuffer(text.encode(), "uint8")
    whole, pieces = shingles._piece_hashes(data), shingles._word_hashes(data)
    assert len(data) > 4 * shingles.GROUP_BYTES
    assert all(np.array_equal(a, b) for a, b in zip(whole, pieces))
    assert len(shingles._POWERS["up"]) <= 4 * shingles.GROUP_BYTES
