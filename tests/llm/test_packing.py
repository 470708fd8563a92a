import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm import packing as P


def first_fit(lengths, capacity):
    """Brute force: each length in falling order into the first container with room."""
    room = []
    for n in sorted(lengths, reverse=True):
        i = next((i for i, r in enumerate(room) if r >= n), None)
        if i is None:
            room.append(capacity - n)
        else:
            room[i] -= n
    return room


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 256), st.integers(1, 60), max_size=25))
def test_plan_holds_everything(histogram):
    kinds = P.plan(histogram, capacity=256, bins=32)
    placed = {}
    for n, one in kinds:
        assert n > 0 and sum(x * k for x, k in one.items()) <= 256
        for x, k in one.items():
            placed[x] = placed.get(x, 0) + n * k
    assert placed == histogram


def test_little_space_is_left():
    rng = random.Random(2)
    histogram = {}
    for _ in range(20_000):
        x = min(2048, max(1, int(rng.lognormvariate(5.5, 0.9))))
        histogram[x] = histogram.get(x, 0) + 1
    kinds = P.plan(histogram)
    total = sum(x * n for x, n in histogram.items())
    assert total / (2048 * sum(n for n, _ in kinds)) > 0.99
    made, left = P.by_patterns(histogram)
    assert sum(left.values()) < 0.35 * 20_000 and sum(n for n, _ in made) > 0.85 * sum(n for n, _ in kinds)


def test_a_column_of_the_residual_is_the_worthiest():
    used, worth = np.array([2, 3, 7]), np.array([1.0, 1.6, 3.0])
    best = max((k for k in itertools.product(range(7), range(5), range(2)) if np.dot(k, used) == 13), key=lambda k: np.dot(k, worth))
    assert tuple(P._worthiest(used, worth, 13)) == best
    assert P._worthiest(np.array([4]), np.array([1.0]), 13) is None


def test_nnls():
    rng = np.random.default_rng(0)
    a, x = rng.random((30, 12)), np.maximum(rng.normal(size=12), 0)
    assert np.allclose(P.nnls(a, a @ x)[1], x, atol=1e-6)
    y = P.nnls(a, -np.ones(30))[1]
    assert (y == 0).all()


def test_containers(spark):
    rng = random.Random(4)
    words = "alpha beta gamma delta epsilon".split()
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 5, 5, 40, 90]))), 7) for i in range(400)] + [(1000, " ".join(words * 90), 7), (1001, None, 7), (1002, "", 7), (5, "alpha beta", 7)]
    df = spark.createDataFrame(docs, "doc_id long, text string, container_id int")
    sizes = {}
    for r in P.measure(df).collect():
        sizes.setdefault(r["doc_id"], []).append(r["n_tokens"])
    rows = P.pack(df, capacity=128).collect()
    by_doc, load = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["n_tokens"]))
        load[r["container_id"]] = load.get(r["container_id"], 0) + r["n_tokens"]
    assert max(load.values()) <= 128 and sorted(load) == list(range(len(load)))
    assert set(by_doc) == set(sizes) and all(sum(n for _, n in by_doc[d]) == sum(sizes[d]) for d in sizes)
    assert all(len(p) == 1 for d, p in by_doc.items() if max(sizes[d]) <= 128 and len(sizes[d]) == 1)
    assert sorted(by_doc[1000])[0] == (0, 128) and [p for p, _ in sorted(by_doc[1000])] == list(range(len(by_doc[1000])))
    assert len(load) <= len(first_fit([n for _, n in itertools.chain.from_iterable(by_doc.values())], 128))
    assert P.pack(df.limit(0)).count() == 0
    got = P.report(P.pack(df, capacity=128), 128).collect()[0]
    assert got["overfull"] == 0 and got["containers"] == len(load)


def test_one_length_many_texts(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "'alpha beta gamma' AS text")
    n = P.measure(df).first()["n_tokens"]
    rows = P.pack(df, capacity=10 * n).groupBy("container_id").count().collect()
    assert len(rows) == 300 and all(r["count"] == 10 for r in rows)


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_tokenizer_is_a_parameter(spark, vocabulary):
    df = spark.createDataFrame([(1, "größer 出張承認 <|endoftext|>")], "doc_id long, text string")
    own = P.encoder(*P.files(P.TOKENIZERS, vocabulary))
    assert P.measure(df, vocabulary=vocabulary).first()["n_tokens"] == len(own.encode_ordinary("größer 出張承認 <|endoftext|>"))
