"""Language of documents and of the segments of mixed ones, by Kneser-Ney character models.

One interpolated Kneser-Ney model of order ``ORDER`` per language is trained on a bounded sample of labelled
sentences. All models live in one set of sorted hash arrays: of every n-gram the hash, and beside it a row with the
discounted probability mass and the back-off mass in each language, found by binary search. A sentence gets the
language of the lowest cross-entropy per character; its confidence is the softmax of the code lengths at a temperature
fitted on held-out sentences, times the share of held-out sentences given to that language that are of it. It is
rejected where the cross-entropy lies beyond what held-out sentences of that language show (the calibrated bound) or
the lead over the second is too small.

Training sample: of every label about ``SAMPLE_DOCUMENTS`` documents, chosen by a hash of their id before any text is
cut, and of their distinct sentences (digits as 0, at most ``SAMPLE_CHARACTERS`` characters) ``TRAIN_SENTENCES``, half
of them the most frequent and half chosen by hash, each under the label that most of its documents bear, which outvotes
wrong labels. Sentences of fewer than ``TRUSTED`` documents or of disputed label are left out of the final models if a
model made without them puts them into another language. Where some language has ``SURE_SENTENCES`` sentences of certain
label, languages without them aren't learned: a code that only wrong labels bear makes no language. The sample is
bounded whatever the corpus, its sentences are all that is shuffled, and the models are some MB and are broadcast.

Every document is classified whole. Log lines, table rows, paths and signatures are no text; quote marks at line
starts are dropped and wrapped lines joined.

Defined results: null and empty texts have no language and are no case; a text without one whole sentence is judged as
one segment; segments that are rejected count for no language; repeated documents count each under their own id;
without any labelled sentence nothing can be learned, and every text has no language; in a text with whole sentences, a
fragment of less than ``SHORT`` characters that is none is a name or a heading and has no language.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ORDER = 5
TRAIN_SENTENCES = 3000
#: Documents of a label that the sample is drawn from, and the length of sentences in it.
SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS = 1500, 400
#: Sentences of certain label that a language needs, where any language has as many.
SURE_SENTENCES = 20
#: Characters of a fragment that is judged beside whole sentences.
SHORT = 25
#: Documents with one label, and their share, that make a sentence's label certain.
TRUSTED, TRUSTED_SHARE = 4, 0.6
#: Least lead over the second language, in nats per character and in nats in all.
LEAD, LEAD_ALL = 0.05, 4.0
#: Share of held-out sentences of the language that the calibrated bound keeps, and of the other languages that it may keep.
KEEP, PASS = 0.999, 0.2
#: Temperatures that are tried; none sharpens.
TEMPERATURES = (1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 12.0, 16.0, 24.0, 32.0)
#: Letters and words of a whole sentence.
SENTENCE_LETTERS, SENTENCE_WORDS, SPACELESS_LETTERS = 16, 4, 9

# Two-letter codes of languages.
CODES = (
    "aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu fa ff fi fj fo fr fy ga gd gl "
    "gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk "
    "ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta "
    "te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu"
)

# Names of the languages as labels spell them, besides codes with or without a region.
NAMES = {
    "de": "german deutsch deu ger allemand alemán tedesco duits alemão ドイツ語", "en": "english englisch eng anglais inglés inglese engels inglês 英語",
    "es": "spanish spanisch spa español espanol castellano espagnol spagnolo spaans espanhol スペイン語", "fr": "french französisch fra fre français francais francés francese frans francês フランス語",
    "it": "italian italienisch ita italiano italien italiaans イタリア語", "ja": "japanese japanisch jpn 日本語 japonais japonés giapponese japans japonês",
    "nl": "dutch niederländisch nld dut nederlands néerlandais neerlandés olandese holandês オランダ語", "pt": "portuguese portugiesisch por português portugues portugais portugués portoghese portugees ポルトガル語",
}

_B = np.uint64(0x9E3779B97F4A7C15)
_LOG = re.compile(r"^\s*\d{4}-\d\d-\d\d[T ]\d\d:\d\d")
_QUOTE = re.compile(r"^\s*(?:>+|\|)\s+(?=\S)")
_END = re.compile(r"(?<=[.!?…．])[\"”’»)\]]*\s+|(?<=[。！？])[」』）]*")
_DONE = re.compile(r"[.!?…。！？．][\"”’»“)\]」』）]*\**$")
_DIGITS = re.compile(r"\d+")
_SPACELESS = re.compile(r"[぀-ヿ㐀-鿿]")
_CLEAN = "".join(map(chr, (*range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), 0xAD, 0xFEFF)))


def canonical(label: Column) -> Column:
    """Two-letter code of a label, or null if it is missing or names no language."""
    bare = F.lower(F.trim(F.regexp_replace(label, r"[\s ]+", " ")))
    known = {c: c for c in CODES.split()} | {n: code for code, names in NAMES.items() for n in (code, *names.split())}
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.element_at(table, bare), F.element_at(table, F.regexp_extract(bare, r"^([a-z]{2,3})[-_]", 1)))


def plain(text: str) -> str:
    """As the models see it: width and case folded, digits as 0, one blank between words."""
    if not text.isascii():
        if any(c in text for c in _CLEAN):
            text = text.translate(dict.fromkeys(map(ord, _CLEAN)))
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    return " ".join(_DIGITS.sub("0", text).split())


def sentences(text: str) -> list[tuple[str, int, bool]]:
    """(sentence, place of its first character, whole) of the running text of a document."""
    out: list[tuple[str, int, bool]] = []
    block: list[tuple[str, int]] = []

    def close() -> None:
        if not block:
            return
        joined, starts, places = "", [], []
        for line, at in block:
            if joined and not _SPACELESS.match(joined[-1]) and not _SPACELESS.match(line[:1]) and joined[-1] not in "。、":
                joined += " "
            starts.append(len(joined))
            places.append(at)
            joined += line
        begin = 0
        for stop in [m.end() for m in _END.finditer(joined)] + [len(joined)]:
            raw = joined[begin:stop]
            piece = raw.strip()
            if piece:
                lead = begin + len(raw) - len(raw.lstrip())
                k = bisect_right(starts, lead) - 1
                whole = _DONE.search(piece) is not None and (sum(map(str.isalpha, piece)) >= SPACELESS_LETTERS if _SPACELESS.search(piece) else len(piece.split()) >= SENTENCE_WORDS and sum(map(str.isalpha, piece)) >= SENTENCE_LETTERS)
                out.append((piece, places[k] + lead - starts[k], whole))
            begin = stop
        block.clear()

    at, signature = 0, False
    for line in text.split("\n"):
        bare = line.strip()
        if bare in ("--", "—"):
            close()
            signature = True
        elif not bare:
            close()
            signature = signature and not out
        elif signature or _LOG.match(line) or (bare.startswith("|") and bare.endswith("|")) or bare.count("|") > 1 or bare.count("\t") > 1 or ("\\" in bare and not _DONE.search(bare)):
            close()
        else:
            m = _QUOTE.match(line)
            lead = m.end() if m else len(line) - len(line.lstrip())
            block.append((line[lead:].rstrip(), at + lead))
        at += len(line) + 1
    close()
    return out


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each after ``ORDER`` - 1 marks, and the number of the text of each."""
    joined = "".join("\x02" * (ORDER - 1) + t for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    which = np.repeat(np.arange(len(texts)), [len(t) + ORDER - 1 for t in texts])
    return codes, which


def _hashes(codes: np.ndarray) -> list[np.ndarray]:
    """Hash of the k-gram that ends at each place, k = 1..ORDER."""
    out, h = [], np.zeros(len(codes), np.uint64)
    mixed = (codes + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(31)
    for k in range(ORDER):
        shifted = np.concatenate((np.zeros(k, np.uint64), mixed[: len(mixed) - k])) if k else mixed
        h = h * _B + (shifted + np.uint64(k + 1)) * np.uint64(2 * k + 3)
        g = h ^ (h >> np.uint64(29))
        out.append(g * np.uint64(0x94D049BB133111EB) + np.uint64(k))
    return out


class Models:
    """Interpolated Kneser-Ney models of all languages in shared sorted hash arrays."""

    def __init__(self, sample: dict[str, list[str]]):
        self.languages = sorted(sample)
        n = len(self.languages)
        self.bound, self.temperature, self.precision = np.full(n, np.inf), 1.0, np.ones(n)
        if not n:
            return
        per = [self._count(sample[lang]) for lang in self.languages]
        alphabet = len(np.unique(np.concatenate([p[0][0] for p in per]))) + 1
        self.floor = 1.0 / alphabet
        self.grams, self.mass, self.heads, self.back = [], [], [], []
        for k in range(ORDER):
            keys = np.unique(np.concatenate([p[k][0] for p in per]))
            heads = np.unique(np.concatenate([p[k][2] for p in per]))
            mass, back = np.zeros((len(keys), n), np.float32), np.ones((len(heads), n), np.float32)
            for j, p in enumerate(per):
                grams, counts, contexts = p[k]
                ones, twos = (counts == 1).sum(), (counts == 2).sum()
                discount = ones / (ones + 2 * twos) if ones and twos else 0.75
                head, inverse = np.unique(contexts, return_inverse=True)
                total = np.bincount(inverse, counts, minlength=len(head))
                kinds = np.bincount(inverse, minlength=len(head))
                mass[np.searchsorted(keys, grams), j] = (counts - discount) / total[inverse]
                back[np.searchsorted(heads, head), j] = discount * kinds / total
            self.grams.append(keys)
            self.mass.append(mass)
            self.heads.append(heads)
            self.back.append(back)

    @staticmethod
    def _count(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(n-grams, counts, contexts) of each order; below the highest, counts are continuation counts."""
        codes, _ = _codes(texts)
        real = codes != 2
        hashes = _hashes(codes)
        before = [np.concatenate((np.zeros(1, np.uint64), h[:-1])) for h in hashes]
        out: list = [None] * ORDER
        top, at, counts = np.unique(hashes[-1][real], return_index=True, return_counts=True)
        out[-1] = (top, counts.astype(float), before[ORDER - 2][real][at])
        for k in range(ORDER - 2, -1, -1):
            # Each distinct (k+2)-gram continues its (k+1)-gram once.
            _, first = np.unique(hashes[k + 1][real], return_index=True)
            own = hashes[k][real][first]
            grams, at, counts = np.unique(own, return_index=True, return_counts=True)
            contexts = before[k - 1][real][first][at] if k else np.zeros(len(grams), np.uint64)
            out[k] = (grams, counts.astype(float), contexts)
        return out

    @staticmethod
    def _find(keys: np.ndarray, want: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        return np.where(keys[at] == want, at, -1)

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Cross-entropy per character (nats) of each text in each language."""
        if not texts:
            return np.empty((0, len(self.languages)))
        codes, which = _codes(texts)
        hashes = _hashes(codes)
        real = np.flatnonzero(codes != 2)
        # The same (ORDER)-gram has the same probability wherever it stands.
        distinct, at, inverse = np.unique(hashes[-1][real], return_index=True, return_inverse=True)
        place = real[at]
        prob = np.full((len(place), len(self.languages)), self.floor, np.float32)
        for k in range(ORDER):
            if k:
                head = self._find(self.heads[k], hashes[k - 1][place - 1])
                prob *= np.where((head >= 0)[:, None], self.back[k][head], 1)
            else:
                prob *= self.back[0][0]
            gram = self._find(self.grams[k], hashes[k][place])
            prob += np.where((gram >= 0)[:, None], self.mass[k][gram], 0)
        logs = -np.log(np.maximum(prob, 1e-12))
        total = np.stack([np.bincount(which[real], logs[inverse, j], minlength=len(texts)) for j in range(len(self.languages))], 1)
        size = np.bincount(which[real], minlength=len(texts))
        return total / np.maximum(size, 1)[:, None]

    def judge(self, texts: list[str]) -> list[tuple[str | None, float]]:
        """(language or None if rejected, confidence) of each text."""
        if not texts or not self.languages:
            return [(None, 0.0)] * len(texts)
        h, size = self.entropies(texts), np.array([len(t) for t in texts])
        rows = np.arange(len(texts))
        best = h.argmin(1)
        own = h[rows, best]
        second = np.where(np.arange(h.shape[1])[None, :] == best[:, None], np.inf, h).min(1) if h.shape[1] > 1 else np.full(len(texts), np.inf)
        lead = second - own
        sure = self.precision[best] / np.exp(np.maximum(-(h - own[:, None]) * size[:, None] / self.temperature, -700)).sum(1)
        kept = (own <= self.bound[best]) & (lead >= LEAD) & (lead * size >= LEAD_ALL)
        return [(self.languages[b] if k else None, float(x)) for b, k, x in zip(best, kept, sure, strict=True)]

    def calibrate(self, held: dict[str, list[str]]) -> None:
        """Per language: what its own held-out sentences need, or what nearly all sentences of other languages exceed."""
        for j, lang in enumerate(self.languages):
            own = self.entropies(held.get(lang, []))[:, j]
            other = self.entropies([t for k, v in held.items() if k != lang for t in v])[:, j]
            if len(own) >= 20 and len(other) >= 20:
                self.bound[j] = max(np.quantile(own, KEEP) * 1.25, np.quantile(other, PASS))
        texts = [(t, j) for j, lang in enumerate(self.languages) for t in held.get(lang, [])]
        h, size, true = self.entropies([t for t, _ in texts]), np.array([len(t) for t, _ in texts]), np.array([j for _, j in texts])
        given = h.argmin(1)
        for j in range(len(self.languages)):
            self.precision[j] = (((given == j) & (true == j)).sum() + 1) / ((given == j).sum() + 1 + 1 / len(self.languages))
        if len(texts) < 20:
            return
        bits = -(h - h.min(1, keepdims=True)) * size[:, None]

        def loss(temperature: float) -> float:
            return float((np.log(np.exp(np.maximum(bits / temperature, -700)).sum(1)) - bits[np.arange(len(true)), true] / temperature).mean())

        self.temperature = min(TEMPERATURES, key=loss)


def _sampled(documents: DataFrame, per_label: int) -> DataFrame:
    """code and text of about so many documents of each label, by a hash of their id; only their labels are counted."""
    own = documents.select(canonical(F.col("lang")).alias("code"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = {r["code"]: r["count"] for r in own.where(F.col("code").isNotNull() & F.col("text").isNotNull()).groupBy("code").count().collect()}
    if not counts:
        return own.where(F.lit(False)).select("code", "text")
    share = F.create_map(*[F.lit(x) for code, n in counts.items() for x in (code, min(1.0, per_label / n))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1_000_000)) < F.try_element_at(share, F.col("code")) * 1_000_000
    return own.where(drawn & F.col("text").isNotNull()).select("code", "text")


def _labelled(sample: DataFrame) -> DataFrame:
    """code, sentence, n, share: distinct sentences under their most frequent label."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            counts: dict[tuple[str, str], int] = {}
            bare: dict[str, str] = {}
            for lang, text in zip(pdf["code"], pdf["text"], strict=True):
                own = {x for x, _, whole in sentences(text) if whole}
                for s in {bare.get(x) or bare.setdefault(x, plain(x)) for x in own}:
                    if len(s) <= SAMPLE_CHARACTERS:
                        counts[lang, s] = counts.get((lang, s), 0) + 1
            yield pd.DataFrame([(a, b, n) for (a, b), n in counts.items()], columns=["code", "sentence", "n"])

    each = sample.mapInPandas(run, "code string, sentence string, n long").groupBy("sentence", "code").agg(F.sum("n").alias("n"))
    best = each.groupBy("sentence").agg(F.max(F.struct("n", "code")).alias("m"), F.sum("n").alias("all"))
    return best.select(F.col("m.code").alias("code"), "sentence", F.col("m.n").alias("n"), (F.col("m.n") / F.col("all")).alias("share"))


def train(documents: DataFrame, per_language: int = TRAIN_SENTENCES, per_label: int = SAMPLE_DOCUMENTS) -> Models:
    """Models from a bounded sample of the labelled documents."""
    known = _labelled(_sampled(documents, per_label))
    half = per_language // 2
    mark = F.xxhash64("sentence")
    often = F.row_number().over(W.partitionBy("code").orderBy(F.desc("n"), mark, "sentence"))
    drawn = F.row_number().over(W.partitionBy("code").orderBy(mark, "sentence"))
    # The windows are over the sample, whose size doesn't follow the corpus; per_language rows of a language are collected.
    rows = known.withColumns({"often": often, "drawn": drawn}).where((F.col("often") <= half) | (F.col("drawn") <= half)).orderBy("code", "often").collect()
    picked_: dict[str, dict[str, bool]] = {}
    for r in rows:
        picked_.setdefault(r["code"], {})[r["sentence"]] = r["n"] >= TRUSTED and r["share"] >= TRUSTED_SHARE
    if any(sum(p.values()) >= SURE_SENTENCES for p in picked_.values()):
        picked_ = {k: p for k, p in picked_.items() if sum(p.values()) >= SURE_SENTENCES}
    sure: dict[str, list[str]] = {}
    rare: list[dict[str, list[str]]] = [{}, {}]
    for lang, picked in sorted(picked_.items()):
        sure[lang] = [s for s, x in picked.items() if x]
        for i in (0, 1):
            rare[i][lang] = [s for s, x in picked.items() if not x][i::2]
    sure = {k: v for k, v in sure.items() if v or rare[0][k]}
    if not sure:
        return Models({})
    models = [Models({k: v + rare[i][k] for k, v in sure.items()}) for i in (0, 1)]
    kept: list[dict[str, list[str]]] = []
    for i in (0, 1):
        judge_ = models[1 - i]
        best = {k: np.argmin(judge_.entropies(rare[i][k]), 1) for k in sure}
        kept.append({k: [t for t, b in zip(rare[i][k], best[k], strict=True) if judge_.languages[b] == k] for k in sure})
    trial = Models({k: (v[::2] + kept[0][k]) or rare[0][k] for k, v in sure.items()})
    trial.calibrate({k: v[1::2] + kept[1][k] for k, v in sure.items()})
    final = Models({k: (v + kept[0][k] + kept[1][k]) or rare[0][k] for k, v in sure.items()})
    final.bound, final.temperature, final.precision = trial.bound, trial.temperature, trial.precision
    return final


def segments(documents: DataFrame, models: Models) -> DataFrame:
    """doc_id, label, main (language of most text), langs (of whole sentences), segments (lang, begin, length, confidence)."""
    shared = documents.sparkSession.sparkContext.broadcast(models)
    piece = "struct<lang:string,begin:int,length:int,confidence:double,whole:boolean>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge_ = shared.value.judge
        for pdf in batches:
            split = [sentences(t) if t and t.strip() else [] for t in pdf["text"]]
            split = [s if any(w for *_, w in s) or not s else [(" ".join(x for x, *_ in s), s[0][1], False)] for s in split]
            bare = {x: plain(x) for x in {x for s in split for x, *_ in s}}
            texts = sorted(set(bare.values()))
            judged_ = dict(zip(texts, judge_(texts), strict=True))
            known = {x: judged_[y] for x, y in bare.items()}
            out = []
            for doc, label, parts in zip(pdf["doc_id"], pdf["label"], split, strict=True):
                short = lambda x, whole: not whole and len(x) < SHORT and len(parts) > 1  # noqa: E731, B023
                judged = [(*((None, 0.0) if short(x, whole) else known[x]), at, len(x), whole) for x, at, whole in parts]
                size: dict[str, int] = {}
                for lang, _, _, n, _ in judged:
                    if lang:
                        size[lang] = size.get(lang, 0) + n
                main = max(sorted(size), key=size.get) if size else None
                langs = sorted({lang for lang, _, _, _, whole in judged if lang and whole})
                merged: list[dict] = []
                for lang, sure, at, n, whole in judged:
                    if not lang:
                        continue
                    if merged and merged[-1]["lang"] == lang:
                        last = merged[-1]
                        last["confidence"] = (last["confidence"] * last["length"] + sure * n) / (last["length"] + n)
                        last["length"], last["whole"] = at + n - last["begin"], last["whole"] or whole
                    else:
                        merged.append({"lang": lang, "begin": at + 1, "length": n, "confidence": sure, "whole": whole})
                out.append((doc, label, main, langs or ([main] if main and not any(w for *_, w in parts) else []), merged))
            yield pd.DataFrame(out, columns=["doc_id", "label", "main", "langs", "segments"])

    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), canonical(F.col("lang")).alias("label"), F.col("text").cast("string").alias("text"))
    return own.mapInPandas(run, f"doc_id long, label string, main string, langs array<string>, segments array<{piece}>")


def label(documents: DataFrame, models: Models | None = None) -> DataFrame:
    """One row per segment: doc_id, label, main, lang, begin (from 1), length, confidence."""
    return segments(documents, models or train(documents)).select("doc_id", "label", "main", F.explode("segments").alias("s")).select("doc_id", "label", "main", "s.lang", "s.begin", "s.length", "s.confidence")


def report(documents: DataFrame) -> DataFrame:
    """Documents per label and main language, with how many are mixed."""
    return segments(documents, train(documents)).groupBy(F.coalesce("label", F.lit("none")).alias("label"), F.coalesce("main", F.lit("none")).alias("main")).agg(F.count("*").alias("n_docs"), F.count_if(F.size("langs") > 1).alias("n_mixed"))


def found(documents: DataFrame) -> DataFrame:
    """doc_id, lang of mislabelled and of mixed documents."""
    every = segments(documents, train(documents))
    case = F.col("label").isNull() | (F.col("label") != F.col("main")) | (F.size("langs") > 1)
    return every.where(F.col("main").isNotNull() & case).select("doc_id", F.explode("langs").alias("lang"))
