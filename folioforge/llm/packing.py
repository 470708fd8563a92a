"""Filling containers of fixed capacity with texts: pattern packing by non-negative least squares.

Texts are measured in tokens of a public tokenizer. A text longer than a container is cut into full containers and one
remainder; nothing else is cut. The lengths make a histogram of at most ``capacity`` bins. On the driver, which sees
only the histogram, patterns of up to ``PATTERN_DOCS`` lengths that fill a container are enumerated over coarser bins,
and patterns of any number of lengths are added where the residual of the fit asks for them. Their repeat counts are
fitted to the histogram by non-negative least squares, rounded and filled with real lengths, and what the rounding
leaves is fitted again, as long as that makes containers. What then is left, a few containers, is packed best-fit in
order of falling length, into the gaps of the pattern containers first. The result is a list of container kinds with
counts, bounded by the histogram, not by the corpus.

On the cluster every text gets its rank among those of its length: by counts per (bucket, length), so that a length that
a third of all texts share needs no single task. The rank picks its container from the list by binary search.

Defined results: null and empty texts take no container and give no row; texts of equal length are placed in the order
of their buckets and ids; repeated rows with one id are packed each.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CAPACITY = 2048
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PATTERN_DOCS = 3
BINS = 128
#: Buckets in which ranks are counted: at least so many, and one for so many texts.
BUCKETS, BUCKET_ROWS = 64, 1_000_000

@lru_cache(maxsize=4)
def files(folder: str, vocabulary: str) -> tuple[str, bytes]:
    """Split pattern and vocabulary of a tokenizer, read where the job is started; they go to the executors with it."""
    spec = importlib.util.spec_from_file_location("tokenizer_files", os.path.join(folder, "__init__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    with open(os.path.join(folder, vocabulary), "rb") as f:
        return module.PATTERN, f.read()


@lru_cache(maxsize=4)
def encoder(pattern: str, vocabulary: bytes):
    """The tokenizer, made once per worker."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("texts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def measure(documents: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens of every text that has tokens."""
    shared = documents.sparkSession.sparkContext.broadcast(files(folder, vocabulary))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(*shared.value)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": np.array([len(own.encode_ordinary(t)) for t in pdf["text"]], np.int64)})

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    return texts.mapInPandas(run, "doc_id long, n_tokens long")


def nnls(a: np.ndarray, b: np.ndarray, price=None, rounds: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """(columns, x): least squares under x >= 0, by active sets (Lawson and Hanson).

    ``price`` may offer a further column for the present residual; it joins the others where none of them serves better.
    """
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    least = 1e-9 * max(1.0, float(np.abs(b).max(initial=0.0)))
    for _ in range(rounds):
        rest = b - a @ x
        slope = a.T @ rest
        slope[free] = -np.inf
        j = int(np.argmax(slope)) if len(slope) else -1
        if price is not None:
            new = price(rest)
            if new is not None and new @ rest > (slope[j] if j >= 0 else -np.inf) + least:
                a, x, free, j = np.column_stack((a, new)), np.append(x, 0.0), np.append(free, False), len(x)
                slope = np.append(slope, new @ rest)
        if j < 0 or slope[j] <= least:
            break
        free[j] = True
        while True:
            own = np.flatnonzero(free)
            part = a[:, own]
            gram, target = part.T @ part, part.T @ b
            try:
                z = np.linalg.solve(gram + 1e-10 * np.eye(len(own)), target)
            except np.linalg.LinAlgError:
                z = np.linalg.lstsq(gram, target, rcond=None)[0]
            if (z > 1e-12).all():
                x[:] = 0
                x[own] = z
                break
            low, zl = own[z <= 1e-12], z[z <= 1e-12]
            step = np.min(x[low] / np.maximum(x[low] - zl, 1e-300))
            x[own] += step * (z - x[own])
            free[low[x[low] <= 1e-12]] = False
            x[~free] = 0
            if not free.any():
                break
    return a, x


def _patterns(used: list[int], bins: int, most: int) -> list[tuple[int, ...]]:
    """Multisets of up to ``most`` of the bins that add up to all ``bins``."""
    out: list[tuple[int, ...]] = []
    there = set(used)

    def go(rest: int, least: int, chosen: tuple[int, ...]) -> None:
        if rest in there and rest >= least:
            out.append((*chosen, rest))
        if len(chosen) + 2 <= most:
            for b in used:
                if least <= b <= rest // 2:
                    go(rest - b, b, (*chosen, b))

    go(bins, 1, ())
    return out


def _worthiest(used: np.ndarray, worth: np.ndarray, bins: int) -> np.ndarray | None:
    """How often each bin is in the multiset that adds up to all bins and is worth most; by dynamic programming."""
    best, last = np.full(bins + 1, -np.inf), np.full(bins + 1, -1)
    best[0] = 0.0
    for total in range(1, bins + 1):
        fits = np.flatnonzero(used <= total)
        if len(fits):
            value = best[total - used[fits]] + worth[fits]
            k = int(np.argmax(value))
            best[total], last[total] = value[k], fits[k]
    if not np.isfinite(best[bins]):
        return None
    out, total = np.zeros(len(used)), bins
    while total:
        out[last[total]] += 1
        total -= int(used[last[total]])
    return out


def _fit(left: dict[int, int], capacity: int, most: int, bins: int) -> list[tuple[tuple[int, ...], float]]:
    """(bins of a pattern in falling order, repeats) that reproduce the histogram best, most repeats first."""
    width = -(-capacity // bins)
    have: dict[int, int] = defaultdict(int)
    for length, n in left.items():
        have[max(1, round(length / width))] += n
    used = np.array(sorted(have))
    start = _patterns(used.tolist(), capacity // width, most)
    place = {b: i for i, b in enumerate(used.tolist())}
    a = np.zeros((len(used), len(start)))
    for j, p in enumerate(start):
        for b in p:
            a[place[b], j] += 1
    # Bins count by what they hold, so that long texts, which nothing replaces, are reproduced too.
    weight = np.sqrt(used.astype(float))
    columns, x = nnls(a * weight[:, None], np.array([float(have[b]) for b in used.tolist()]) * weight, lambda rest: None if (c := _worthiest(used, rest * weight, capacity // width)) is None else c * weight)
    counts = np.rint(columns / weight[:, None]).astype(int)
    out = [(tuple(int(b) for i in np.flatnonzero(counts[:, j])[::-1] for b in [used[i]] * counts[i, j]), float(x[j])) for j in np.flatnonzero(x > 1e-6)]
    return sorted(out, key=lambda p: (-p[1], p[0]))


def plan(histogram: dict[int, int], capacity: int = CAPACITY, most: int = PATTERN_DOCS, bins: int = BINS) -> list[tuple[int, dict[int, int]]]:
    """Container kinds (how many containers, how many texts of each length in one) that hold the whole histogram."""
    kinds, left = by_patterns(histogram, capacity, most, bins)
    return _best_fit(kinds, left, capacity)


def by_patterns(histogram: dict[int, int], capacity: int = CAPACITY, most: int = PATTERN_DOCS, bins: int = BINS) -> tuple[list[tuple[int, dict[int, int]]], dict[int, int]]:
    """(container kinds made by patterns, what is left of the histogram).

    Repeats are rounded and filled with real lengths: of every bin the longest that is left, and last the longest that
    still fits. What the rounding leaves is fitted again, until a fit makes no more than a tenth of what is left.
    """
    left = {length: n for length, n in histogram.items() if n > 0}
    width = -(-capacity // bins)
    kinds: list[tuple[int, dict[int, int]]] = []
    if n := left.pop(capacity, 0):
        kinds.append((n, {capacity: 1}))
    while left:
        there = sorted(left)
        by_bin: dict[int, list[int]] = defaultdict(list)
        for length in there:
            by_bin[max(1, round(length / width))].append(length)
        before, made = sum(left.values()), 0
        for pattern, repeats in _fit(left, capacity, most, bins):
            want = round(repeats)
            while want > 0:
                one: dict[int, int] = {}
                room = capacity
                for k, b in enumerate(pattern):
                    own = by_bin[b]
                    while own and not left[own[-1]]:
                        own.pop()
                    length = next((x for x in reversed(own) if x <= room and left[x] > one.get(x, 0)), None)
                    if k == len(pattern) - 1:
                        while (at := bisect_right(there, room) - 1) >= 0 and not left[there[at]]:
                            del there[at]
                        while at >= 0 and left[there[at]] <= one.get(there[at], 0):
                            at -= 1
                        length = there[at] if at >= 0 else None
                    if length is None:
                        break
                    one[length] = one.get(length, 0) + 1
                    room -= length
                else:
                    n = min(want, *(left[x] // k for x, k in one.items()))
                    for x, k in one.items():
                        left[x] -= n * k
                    made += n * sum(one.values())
                    kinds.append((n, one))
                    want -= n
                    continue
                break
        left = {x: n for x, n in left.items() if n > 0}
        if made * 10 <= before:
            break
    return kinds, left


def _best_fit(kinds: list[tuple[int, dict[int, int]]], left: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Pack what is left in order of falling length into the tightest gaps; whole groups of like containers at a time."""
    open_: dict[int, list[list]] = defaultdict(list)
    for n, one in kinds:
        open_[capacity - sum(x * k for x, k in one.items())].append([n, one])
    for length in sorted(left, reverse=True):
        n = left[length]
        while n > 0:
            gaps = [g for g, groups in open_.items() if g >= length and groups]
            if gaps:
                gap = min(gaps)
                count, one = open_[gap].pop()
            else:
                gap, one = capacity, {}
                count = max(1, n // max(1, capacity // length))
            each = min(gap // length, -(-n // count) if count <= n else 1)
            take = min(count, n // each)
            if take < count and one:
                open_[gap].append([count - take, one])
            new = dict(one)
            new[length] = new.get(length, 0) + each
            open_[gap - each * length].append([take, new])
            n -= take * each
    return [(n, one) for groups in open_.values() for n, one in groups if n > 0]


def _segments(kinds: list[tuple[int, dict[int, int]]]) -> tuple[np.ndarray, ...]:
    """For each length, in order of ranks: (length, first rank, first container, texts in one)."""
    rows, base, rank = [], 0, defaultdict(int)
    for n, one in kinds:
        for length, each in one.items():
            rows.append((length, rank[length], base, each))
            rank[length] += n * each
        base += n
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else tuple(np.empty(0, np.int64) for _ in range(4))


def pieces(measured: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece (from 0), n_tokens: long texts in full containers and a remainder, all others whole."""
    n = F.col("n_tokens")
    count = F.ceil(n / capacity).cast("int")
    each = measured.where(n > 0).withColumn("piece", F.explode(F.sequence(F.lit(0), count - 1)))
    return each.select("doc_id", "piece", F.least(F.lit(capacity), n - F.col("piece").cast("long") * capacity).cast("int").alias("n_tokens"))


def pack(documents: DataFrame, capacity: int = CAPACITY, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, n_tokens, container_id: the container of each text, or of each piece of one that exceeds the capacity."""
    from folioforge.session import checkpoint

    spark = documents.sparkSession
    buckets = max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-documents.count() // BUCKET_ROWS))
    # The bucket is written with the row, so rows of one id spread evenly and a repeated task finds the same buckets.
    cut = checkpoint(pieces(measure(documents, folder, vocabulary), capacity).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(buckets)).cast("int")))
    counts = cut.groupBy("n_tokens", "bucket").agg(F.count("*").alias("n"))
    # At most capacity rows reach the driver.
    histogram = {r["n_tokens"]: r["n"] for r in counts.groupBy("n_tokens").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(_segments(plan(histogram, capacity)))
    # Rank of the first text of a length in each bucket; a window holds one row per bucket.
    before = F.coalesce(F.sum("n").over(W.partitionBy("n_tokens").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    first = counts.select("n_tokens", "bucket", before.alias("first"))
    wide = 1 << 40

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        length, start, base, each = shared.value
        keys = length * wide + start
        last, ahead = None, 0  # the run that the batch before ended in, and its rows so far
        for pdf in batches:
            bucket, tokens = pdf["bucket"].to_numpy(np.int64), pdf["n_tokens"].to_numpy(np.int64)
            fresh = np.ones(len(pdf), bool)
            fresh[1:] = (bucket[1:] != bucket[:-1]) | (tokens[1:] != tokens[:-1])
            begin = np.flatnonzero(fresh)
            run = np.cumsum(fresh) - 1
            place_ = np.arange(len(pdf)) - begin[run]
            if last == (bucket[0], tokens[0]):
                place_[run == 0] += ahead
            last, ahead = (bucket[-1], tokens[-1]), int(place_[-1]) + 1
            rank = pdf["first"].to_numpy(np.int64) + place_
            at = np.searchsorted(keys, tokens * wide + rank, side="right") - 1
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "piece": pdf["piece"], "n_tokens": pdf["n_tokens"], "container_id": base[at] + (rank - start[at]) // each[at]})

    # All rows of a bucket meet in one task, in order of length and id; a task holds counters only.
    ordered = cut.join(first, ["n_tokens", "bucket"]).select("doc_id", "piece", "n_tokens", "bucket", "first")
    ordered = ordered.repartition(buckets, "bucket").sortWithinPartitions("bucket", "n_tokens", "doc_id", "piece")
    return ordered.mapInPandas(place, "doc_id long, piece int, n_tokens int, container_id long")


def containers(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """container_id, n_texts, n_tokens, unused."""
    return packed.groupBy("container_id").agg(F.count("*").alias("n_texts"), F.sum("n_tokens").alias("n_tokens")).withColumn("unused", F.lit(capacity) - F.col("n_tokens"))


def report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Containers, the least number that could do, share of space used, and containers that overflow (none)."""
    every = containers(packed, capacity)
    return every.agg(F.count("*").alias("containers"), F.ceil(F.sum("n_tokens") / capacity).alias("least"), F.round(F.sum("n_tokens") / (F.count("*") * capacity), 6).alias("used"), F.sum("n_texts").alias("pieces"), F.count_if(F.col("unused") < 0).alias("overfull"))
