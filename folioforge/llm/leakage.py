"""Evaluation texts leaking into training text, by suffix arrays over the training corpus.

The corpus is read in shards of bounded size. Of a shard, a suffix array over its tokens is built (prefix doubling);
every suffix of every test item is binary-searched in it, vectorised over all suffixes, which gives the range of
training suffixes that share the required number of tokens; matches that go on along a diagonal are joined to the
longest verbatim match of a document and an item, with its place.

Tokens are words (runs of letters or digits) for most items and single letters or digits for those of languages without
spaces. Letter case, width, invisible characters, spacing, line breaks, markup and punctuation don't count. A token that
no test item has can't be part of a match, so it ends a run, and runs too short for a match are left out of the suffix
array: that loses nothing.

The items are broadcast in blocks of at most ``BLOCK_TOKENS`` tokens; more items mean more blocks, ``BLOCKS`` of which
are met in one reading of the corpus. Shards follow each other in a task, which holds one of them; a document is never cut. A passage that
many documents of a shard hold is matched with the items once, and its pairs leave the task as they are made.

Defined results: null and empty texts match nothing; items with fewer tokens than a match needs can't leak; repeated
documents or items each count under their own id.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import batched, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 12
MIN_LETTERS = 30
SPACELESS = ("ja", "zh", "th")
SHARD_TOKENS = 2_000_000
BLOCK_TOKENS = 2_000_000
#: Blocks of items that one reading of the corpus serves.
BLOCKS = 4
#: Pairs of a place or document with an item that are held at once.
PAIRS = 2_000_000

_TAG_IN = re.compile(r"</?(?:b|i|u|s|em|strong|span|font|a|sub|sup|small|mark|code)\b[^<>]{0,200}>", re.I)
_TAG = re.compile(r"</?[a-z][a-z0-9]*\b[^<>@]{0,200}>|&nbsp;|&#160;", re.I)
_MARK = re.compile(r"[\u0e00-\u0e7f\u3040-\u30ff\u3400-\u9fff\uff66-\uff9f\U00020000-\U0003ffff]")
_WORDS = re.compile(r"[^\W_]+")


#: Which code points are invisible formatting characters.
_CF = np.zeros(0x110000, bool)
_CF[[c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cf"]] = True


def visible(text: str) -> str:
    """The text without invisible formatting characters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    hidden = _CF[codes]
    return codes[~hidden].tobytes().decode("utf-32-le", "surrogatepass") if hidden.any() else text


def normal(text: str) -> str:
    """Case, width, markup and invisible characters out of the way."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", visible(text))
    if "<" in text or "&" in text:
        text = _TAG.sub(" ", _TAG_IN.sub("", text))
    return text.casefold()


def words(text: str) -> list[str]:
    return _WORDS.findall(normal(text))


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``tokens`` ordered by their first ``depth`` tokens at least."""
    n = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    order, span = np.argsort(rank, kind="stable"), 1
    while span < depth:
        after = np.zeros(n, np.int64)
        after[: n - span] = rank[span:]
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1]))) + 1
        span *= 2
        if rank[order[-1]] == n:
            break
    return order


def _compare(text: np.ndarray, at: np.ndarray, want: np.ndarray) -> np.ndarray:
    """-1, 0 or 1: the tokens of the text at each place against the wanted ones."""
    out = np.zeros(len(at), np.int8)
    open_ = np.arange(len(at))
    for k in range(want.shape[1]):
        a, b = text[at[open_] + k], want[open_, k]
        out[open_[a < b]], out[open_[a > b]] = -1, 1
        open_ = open_[a == b]
        if not len(open_):
            break
    return out


def search(text: np.ndarray, order: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range of the suffix array that begins with each wanted token sequence. ``text`` is padded with zeros."""
    bounds = []
    for upper in (False, True):
        lo, hi = np.zeros(len(want), np.int64), np.full(len(want), len(order), np.int64)
        open_ = np.arange(len(want))
        while len(open_):
            mid = (lo[open_] + hi[open_]) // 2
            c = _compare(text, order[mid], want[open_])
            right = (c <= 0) if upper else (c < 0)
            lo[open_] = np.where(right, mid + 1, lo[open_])
            hi[open_] = np.where(right, hi[open_], mid)
            open_ = open_[lo[open_] < hi[open_]]
        bounds.append(lo)
    return bounds[0], bounds[1]


class Items:
    """A block of test items as token sequences of one kind."""

    def __init__(self, rows: list[tuple[int, list[str]]], need: int):
        rows = [(i, t) for i, t in rows if len(t) >= need]
        self.need, self.depth = need, max((len(t) for _, t in rows), default=0)
        self.ids = {w: k for k, w in enumerate(sorted({w for _, t in rows for w in t}), 1)}
        item, place, want = [], [], []
        for i, t in rows:
            own = np.array([self.ids[w] for w in t], np.int32)
            windows = np.lib.stride_tricks.sliding_window_view(own, need)
            want.append(windows)
            item.append(np.full(len(windows), i, np.int64))
            place.append(np.arange(len(windows)))
        self.want = np.concatenate(want) if want else np.empty((0, need), np.int32)
        self.item = np.concatenate(item) if item else np.empty(0, np.int64)
        self.place = np.concatenate(place) if place else np.empty(0, np.int64)
        # Equal sequences of different items are searched once.
        self.distinct, self.inverse = np.unique(self.want, axis=0, return_inverse=True) if len(self.want) else (self.want, np.empty(0, np.int64))
        self.inverse = self.inverse.reshape(-1)
        # Where each distinct sequence stands: ``many`` entries of ``by`` from ``first`` on.
        self.by = np.argsort(self.inverse, kind="stable")
        self.many = np.bincount(self.inverse, minlength=len(self.distinct))
        self.first = np.concatenate(([0], np.cumsum(self.many)))[:-1]
        # Whether every sequence holds a letter of a script without spaces: then texts without one can't match.
        marks = np.array([False] + [bool(_MARK.match(w)) for w in sorted(self.ids)])
        self.marked = bool(len(self.distinct)) and bool(marks[self.distinct].any(1).all())
        letters = {ord(w): k for w, k in self.ids.items() if len(w) == 1}
        self.letters = np.zeros(max(letters, default=0) + 2, np.int32)
        for c, k in letters.items():
            self.letters[c] = k


def _runs(ids: np.ndarray, need: int) -> np.ndarray:
    """Mask of the tokens in unbroken runs of at least ``need`` known tokens."""
    known = np.concatenate(([0], (ids > 0).astype(np.int8), [0]))
    step = np.flatnonzero(np.diff(known))
    begin, end = step[::2], step[1::2]
    keep = end - begin >= need
    mark = np.zeros(len(ids) + 1, np.int32)
    np.add.at(mark, begin[keep], 1)
    np.add.at(mark, end[keep], -1)
    return np.cumsum(mark[:-1]) > 0


class Shard:
    """Runs of known tokens of the documents read so far."""

    def __init__(self, items: Items):
        self.items, self.parts, self.size = items, [], 0

    def add(self, doc: int, ids: np.ndarray) -> None:
        if len(ids) < self.items.need:
            return
        mask = _runs(ids, self.items.need)
        if not mask.any():
            return
        at = np.flatnonzero(mask)
        gap = np.flatnonzero(np.diff(at) > 1) + 1
        tokens = np.insert(np.append(ids[at], 0), gap, 0)
        place = np.insert(np.append(at, -1), gap, -1)
        self.parts.append((doc, tokens, place))
        self.size += len(tokens)

    def matches(self, most: int = PAIRS) -> Iterator[pd.DataFrame]:
        """doc_id, item_id, longest, doc_place, item_place.

        Places of the text that follow each other in the suffix ranges are one passage. Equal passages are matched with
        the items once, however many documents hold them; only then do documents meet items, about ``most`` at a time.
        """
        parts, self.parts, self.size = self.parts, [], 0
        if not parts or not len(self.items.distinct):
            return
        text = np.concatenate([p[1] for p in parts])
        place = np.concatenate([p[2] for p in parts])
        doc = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
        docs = np.array([p[0] for p in parts], np.int64)
        need = self.items.need
        order = suffix_array(text, self.items.depth)
        padded = np.concatenate((text, np.zeros(need, text.dtype)))
        lo, hi = search(padded, order, self.items.distinct)
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            return
        count = (hi - lo)[hit]
        start = np.repeat(lo[hit] - np.concatenate(([0], np.cumsum(count)[:-1])), count)
        at = order[start + np.arange(count.sum())]
        # Each place begins with one sequence at most.
        seq = np.full(len(text) + 1, -1, np.int64)
        seq[at] = np.repeat(hit, count)
        step = np.flatnonzero(np.diff(np.concatenate(([0], (seq >= 0).astype(np.int8)))))
        begin, end = step[::2], step[1::2]
        kinds: dict[bytes, int] = {}
        kind = np.array([kinds.setdefault(seq[b:e].tobytes(), len(kinds)) for b, e in zip(begin, end, strict=True)])
        first = np.unique(kind, return_index=True)[1]
        found_ = [self._passages(seq, begin[first], end[first], k, n) for k, n in self._chunks(self._weight(seq, begin[first], end[first]), most)]
        passage, item, longest, off, item_place = (np.concatenate(x) for x in zip(*found_, strict=True))
        # Documents with their passages, in blocks of whole documents.
        many = np.bincount(passage, minlength=len(first))
        starts = np.concatenate(([0], np.cumsum(many)))[:-1]
        own = doc[begin]
        edges = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1, [len(own)]))
        pairs = np.concatenate(([0], np.cumsum(many[kind])))
        for a, b in self._chunks(np.diff(pairs[edges]), most):
            x, y = edges[a], edges[b]
            n = many[kind[x:y]]
            which = np.repeat(np.arange(x, y), n)
            source = np.repeat(starts[kind[x:y]] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            all_ = pd.DataFrame({"doc": own[which], "item_id": item[source], "longest": longest[source], "doc_place": place[begin[which] + off[source]], "item_place": item_place[source]})
            best = all_.sort_values(["longest", "doc_place"], ascending=[False, True]).drop_duplicates(["doc", "item_id"])
            yield best.assign(doc_id=docs[best["doc"]])[["doc_id", "item_id", "longest", "doc_place", "item_place"]].astype("int64")

    @staticmethod
    def _chunks(weight: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
        """Neighbouring entries of about so much weight together, one at least."""
        total = np.concatenate(([0], np.cumsum(weight)))
        begin = 0
        while begin < len(weight):
            end = max(begin + 1, int(np.searchsorted(total, total[begin] + most, side="right")) - 1)
            yield begin, end
            begin = end

    def _weight(self, seq: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many places of items meet each passage."""
        many = np.concatenate((self.items.many, [0]))  # the last stands for no sequence
        total = np.concatenate(([0], np.cumsum(many[seq])))
        return total[end] - total[begin]

    def _passages(self, seq: np.ndarray, begin: np.ndarray, end: np.ndarray, a: int, b: int) -> tuple[np.ndarray, ...]:
        """(passage, item, longest match, its place in the passage and in the item) of the passages a to b."""
        size = (end - begin)[a:b]
        p = np.repeat(np.arange(a, b), size)
        o = np.arange(size.sum()) - np.repeat(np.concatenate(([0], np.cumsum(size)[:-1])), size)
        own = seq[begin[p] + o]
        many = self.items.many[own]
        rep = np.repeat(np.arange(len(own)), many)
        source = self.items.by[np.repeat(self.items.first[own] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())]
        p, o, i, q = p[rep], o[rep], self.items.item[source], self.items.place[source]
        # Neighbours on a diagonal are one longer match.
        by = np.lexsort((o, o - q, i, p))
        p, o, i, q = p[by], o[by], i[by], q[by]
        fresh = np.ones(len(p), bool)
        fresh[1:] = (p[1:] != p[:-1]) | (i[1:] != i[:-1]) | (o[1:] != o[:-1] + 1) | (q[1:] != q[:-1] + 1)
        head = np.flatnonzero(fresh)
        length = np.diff(np.append(head, len(p))) + self.items.need - 1
        p, i, o, q = p[head], i[head], o[head], q[head]
        by = np.lexsort((q, o, -length, i, p))
        p, i, length, o, q = p[by], i[by], length[by], o[by], q[by]
        keep = np.ones(len(p), bool)
        keep[1:] = (p[1:] != p[:-1]) | (i[1:] != i[:-1])
        return p[keep], i[keep], length[keep], o[keep], q[keep]


def _blocks(items: DataFrame, block_tokens: int) -> Iterator[list]:
    """The items, cut into tokens on the executors, in blocks of bounded size, streamed to the driver."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = [words(t) for t in pdf["text"]]
            spaceless = [(x or "").split("-")[0] in SPACELESS for x in pdf["l"]]
            yield pd.DataFrame({"i": pdf["i"], "spaceless": spaceless, "tokens": [list("".join(w)) if s else w for w, s in zip(own, spaceless, strict=True)]})

    rows = items.select(F.col("item_id").cast("long").alias("i"), F.lower(F.trim("lang")).alias("l"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    block, size = [], 0
    for row in rows.mapInPandas(cut, "i long, spaceless boolean, tokens array<string>").orderBy("i").toLocalIterator():
        tokens = row["tokens"]
        if block and size + len(tokens) > block_tokens:
            yield block
            block, size = [], 0
        block.append((row["i"], row["spaceless"], tokens))
        size += len(tokens)
    yield block


def leaks(documents: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, min_letters: int = MIN_LETTERS, shard_tokens: int = SHARD_TOKENS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, item_id, longest (tokens), doc_place and item_place (token numbers) of every document and item that share enough."""
    sc = documents.sparkSession.sparkContext
    corpus = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    out = None
    for group in batched(_blocks(items, block_tokens), BLOCKS):
        shared = sc.broadcast([(Items([(i, t) for i, s, t in block if not s], min_words), Items([(i, t) for i, s, t in block if s], min_letters)) for block in group])

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            shards = [(Shard(by_word), Shard(by_letter)) for by_word, by_letter in shared.value]
            for pdf in batches:
                for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                    own = words(text)
                    letters = None
                    for by_word, by_letter in shards:
                        if known := by_word.items.ids:
                            by_word.add(doc, np.fromiter(map(known.get, own, repeat(0)), np.int32, len(own)))
                        if by_letter.items.ids and (not by_letter.items.marked or _MARK.search(text)):
                            if letters is None:
                                letters = np.frombuffer("".join(own).encode("utf-32-le", "replace"), np.uint32)
                            by_letter.add(doc, by_letter.items.letters[np.minimum(letters, len(by_letter.items.letters) - 1)])
                        for shard in (by_word, by_letter):
                            if shard.size >= shard_tokens:
                                yield from shard.matches()
            for pair in shards:
                for shard in pair:
                    yield from shard.matches()

        part = corpus.mapInPandas(run, "doc_id long, item_id long, longest long, doc_place long, item_place long")
        out = part if out is None else out.union(part)
    return out


def report(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per test item: in how many documents it leaked and the longest match."""
    found_ = leaks(documents, items).groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("longest").alias("longest"))
    return items.select("item_id", "suite", "lang").join(found_, "item_id", "left").select("item_id", "suite", "lang", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("longest", F.lit(0)).alias("longest"))


def remove(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without those that hold leaked passages."""
    return documents.join(leaks(documents, items).select("doc_id").distinct(), "doc_id", "left_anti")


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id."""
    return leaks(documents, items).select("doc_id", "item_id").distinct()
