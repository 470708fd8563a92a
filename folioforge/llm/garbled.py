"""Garbled text from wrong character encodings.

Every distinct clean word of the corpus is garbled under all encoding chains; the result is a table
(garbled form, original, chain). The distinct tokens of the texts are hash-joined with that table. A row with a
matching token is affected; matched tokens are put back by the reversed chain where that is exact, else by the
original of the table where there is only one.

Words are cut at ASCII characters other than letters. Besides whole words, their runs of non-ASCII characters count
as words, and since Japanese has no spaces, pairs of neighbouring characters do; their garbled forms are compared by
windows of ``WINDOW`` characters. Words of more than two ``PIECE`` characters without kana or kanji are compared by
overlapping pieces as well, at any length.

Clean words come from the reference corpus (documents, name directory) and from those words of the examined texts
that consist of characters the reference corpus uses, Latin letters, kana, or kanji of the first JIS level. A garbled form counts
only if it can be told from clean text: it isn't a word of the reference corpus, and it holds a replacement character,
or a character of neither kind, or decodes strictly back to the word from UTF-8. Where a form may itself be a clean
word and the encodings garble either way, that of the two is clean which far more distinct texts hold; copies of a text
don't count, but for a tie.

Sizes: the character repertoire is bounded by Unicode. Tokens are broadcast while they take at most
``BROADCAST_BYTES`` as counted and joined by shuffle otherwise.

ISO-2022-JP whose escape characters are lost, and UTF-7, are all ASCII: their pieces are cut by their own marks and looked
up like other tokens. Signs without letters that the examined texts hold count as clean words, but hide no garbled form.

Defined results: null and empty texts and other ASCII texts are no case; a row is reported once however many of its texts
are affected; text that was garbled with loss is found and, where no single original fits, left as it is
(``restored`` false).
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 4
#: Pieces of long words begin at every character; their forms are compared by so many characters. Decoding may halve
#: the number of characters, so a piece has up to twice as many.
PIECE = 12
#: Characters of a word that is compared as a whole.
WHOLE = 40
#: Characters of the longest token with kana or kanji that a word of less than a piece can become: nine for each.
LONGEST = 9 * PIECE
BROADCAST_BYTES = 32 << 20
#: A character is in use if at least so many documents of the reference corpus hold it.
MIN_DOCUMENTS = 2
#: Of a form and its original that may each be the clean one, that in so many times as many distinct texts is.
FREQUENT = 4

_SINGLE = ["cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1251", "koi8_r", "iso8859_15", "cp1250"]
_MULTI = ["cp932", "euc_jp", "gbk", "big5"]
#: Chains of (encoded as, decoded as).
CHAINS: list[tuple[tuple[str, str], ...]] = (
    [(("utf-8", d),) for d in _SINGLE + _MULTI]
    + [(("cp1252", d),) for d in ("utf-8", "cp437", "cp850", "mac_roman", "cp1251", "cp932")]
    + [((e, d),) for e in ("mac_roman", "cp437", "cp850") for d in ("cp1252", "utf-8")]
    + [((e, d),) for e in ("cp932", "euc_jp") for d in ("cp1252", "latin-1", "utf-8", "cp437", "mac_roman", "cp932", "euc_jp", "gbk") if e != d]
    + [(("utf-8", a), ("utf-8", b)) for a in ("cp1252", "latin-1") for b in ("cp1252", "latin-1")]
    + [(("utf-8", d), ("utf-8", d)) for d in ("cp437", "cp850", "mac_roman", "cp1251", "cp932")]
    + [(("utf-8", "cp1252"),) * 3]
    + [(("iso2022_jp", "escapes lost"),), (("utf-7", "ascii"),)]
)
_HOLES = {"cp1252": (0x81, 0x8D, 0x8F, 0x90, 0x9D), "cp1251": (0x98,), "cp1250": (0x81, 0x83, 0x88, 0x90, 0x98)}
#: What ISO-2022-JP leaves where its escape characters are lost, and UTF-7: all ASCII.
_JIS = re.compile(r"\$[B@]((?:[!-~]{2})+?)(?=\([BJ]|[^!-~]|$|[!-~]$)(?:\([BJ])?")
_SEVEN = re.compile(r"\+([A-Za-z0-9/]{3,})-?")
_SEVEN_BITS = {"iso2022_jp", "utf-7"}
_WORD = re.compile(r"(?:[A-Za-z]|[^\x00-\x7f])+")
_RUN = re.compile(r"[^\x00-\x7f]+")
_PAIR = re.compile(r"[^\x00-\x7f\u3000-\u9fff\uff00-\uffef]{2,}")
#: What a lead and a continuation byte of UTF-8 may give in a multibyte decoding: wide characters, Cyrillic in big5.
_WIDE = re.compile("[\u3000-\uffff" + "".join(sorted({c for d in _MULTI for a in range(0xC2, 0xF5) for b in range(0x80, 0xC0) for c in bytes([a, b]).decode(d, "replace") if "\x7f" < c < "\u3000"})) + "]")
_BLANK = re.compile("[\u2000-\u200b\u2010-\u2027\u00a0\u202f]")
_NARROW = re.compile(r"[^\u3000-\u9fff\uff00-\uffef]+")
_KANA = re.compile(r"[぀-ヿ㐀-鿿々ｦ-ﾟ！-～、。「」]")


@lru_cache(maxsize=None)
def _table(name: str) -> list[str]:
    holes = _HOLES.get(name, ())
    return [chr(b) if b in holes else bytes([b]).decode(name) for b in range(256)]


def decode(data: bytes, name: str) -> str:
    """As browsers and mail programs do: bytes without a character become control characters or U+FFFD."""
    if name in _SINGLE:
        table = _table(name)
        return "".join([table[b] for b in data])
    if name == "escapes lost":
        return data.decode("ascii").replace("\x1b", "")
    return data.decode(name, "replace")


@lru_cache(maxsize=None)
def _back(name: str) -> dict[str, int]:
    return {c: b for b, c in enumerate(_table(name))}


def encode(text: str, name: str) -> bytes:
    """The inverse of ``decode``; UnicodeError if there is none."""
    if name in _SINGLE:
        try:
            return bytes([_back(name)[c] for c in text])
        except KeyError:
            raise UnicodeError(name) from None
    if name == "escapes lost":
        raise UnicodeError(name)
    return text.encode(name)


def garble(word: str, chain: Iterable[tuple[str, str]]) -> str | None:
    try:
        for written, read in chain:
            word = decode(encode(word, written), read)
    except UnicodeError:
        return None
    return word


def ungarble(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The exact original, if each step can be reversed without loss."""
    if "�" in text:
        return None
    original = text
    try:
        for written, read in reversed(chain):
            data = encode(text, read)
            text = data.decode(written) if written not in _SINGLE else decode(data, written)
    except UnicodeError:
        return None
    return text if text != original and garble(text, chain) == original else None


def name_of(chain: tuple[tuple[str, str], ...]) -> str:
    return " ".join(f"{a}>{b}" for a, b in chain)


CHAIN_OF = {name_of(c): c for c in CHAINS}


@lru_cache(maxsize=None)
def common(c: str) -> bool:
    """Kana, full-width forms and kanji of the first JIS level."""
    if "\u3040" <= c <= "\u30ff" or "\uff01" <= c <= "\uff5e" or c in "々〒　":
        return True
    if not "\u4e00" <= c <= "\u9fff":
        return False
    try:
        return 0x88 <= c.encode("cp932")[0] <= 0x98
    except UnicodeError:
        return False


def odd(text: str, used: set[str]) -> int:
    """Characters that neither the reference corpus uses nor are common."""
    return sum(c > "\x7f" and c not in used and not common(c) for c in text)


def odd_pattern(used: set[str]) -> re.Pattern:
    """A replacement character, or one that neither the reference corpus uses nor is common."""
    fine = sorted({*used, *(c for c in map(chr, range(0x3000, 0x10000)) if common(c))} - {"�"})
    return re.compile("[^\\x00-\\x7f" + "".join(map(re.escape, fine)) + "]")


def symbols(w: str) -> bool:
    """Line drawings, arrows and other signs without a letter or digit, which texts hold whatever their language."""
    return all(c > "\x7f" and unicodedata.category(c)[0] in "SP" and c != "\ufffd" for c in w)


def parts(w: str) -> set[str]:
    """What a word with a non-ASCII character gives: itself, its non-ASCII runs, neighbouring characters of Japanese.

    A word of more than two pieces without Japanese gives its pieces with a non-ASCII character, beyond ``WHOLE``
    characters instead of itself; what stands between Japanese is a word of its own.
    """
    out: set[str] = set()
    words = [w, *(p for p in _BLANK.split(w) if p != w)]
    if _KANA.search(w):
        words += _NARROW.findall(w)
        for run in _RUN.findall(w):
            if len(run) > 1:
                out.update([p for p in map("".join, zip(run, run[1:], strict=False)) if _KANA.match(p)])
    for own in words:
        if not own or own.isascii():
            continue
        japanese = _KANA.search(own) is not None
        if len(own) <= (12 if japanese else WHOLE):  # longer Japanese is all in the pairs
            out.add(own)
        if not japanese and len(own) > 2 * PIECE:
            out.update([own[i : i + 2 * PIECE] for i in range(len(own) - PIECE + 1) if not own[i : i + PIECE].isascii()])
        out.update([r for r in _RUN.findall(own) if len(r) <= 12 or (len(r) <= WHOLE and not _KANA.search(r))])
    return out


def from_utf8(token: str) -> bool:
    """Whether a multibyte encoding gives bytes that are valid UTF-8."""
    for name in _MULTI:
        try:
            token.encode(name).decode("utf-8")
        except UnicodeError:
            continue
        return True
    return False


def seven_bit(text: str) -> set[str]:
    """Tokens of ISO-2022-JP without escapes (two characters each, a lone one with its end) and of UTF-7."""
    out: set[str] = set()
    if "$B" in text or "$@" in text:
        for m in _JIS.finditer(text):
            own = m.group(1)
            out.update(["$B" + own[i : i + 4] for i in range(0, len(own) - 3, 2)])
            if len(own) == 2:
                out.add(f"$B{own}(B")
    if "+" in text:
        for own in _SEVEN.findall(text):
            try:  # telephone numbers and the like decode to nothing
                f"+{own}-".encode("ascii").decode("utf-7")
            except UnicodeError:
                continue
            out.add(f"+{own}-")
    return out


def tokens(text: str, odd_: re.Pattern) -> set[str]:
    """What is looked up in the table: words, runs, windows that hold an odd character, and what seven-bit encodings leave."""
    seven = seven_bit(text)
    return seven if text.isascii() else seven | _tokens(text, odd_)


def _tokens(text: str, odd_: re.Pattern) -> set[str]:
    """Words, runs, and windows that hold an odd character.

    Every form of the table holds an odd character, a pair of narrow ones (a lead and a continuation byte), or, out of
    a multibyte decoding, a wide one and then decodes strictly back from UTF-8. So a text with none of these has no
    token that could match, and a text without the first two only tokens that decode so.
    """
    at = [m.start() for m in odd_.finditer(text)]
    plain = not at and not _PAIR.search(text)
    if plain and not _WIDE.search(text):
        return set()
    out: set[str] = set()
    for w in _WORD.findall(text):
        if not w.isascii():
            # Longer ones with kana or kanji are clean Japanese, or forms that windows and pieces find.
            if len(w) <= LONGEST or not _KANA.search(w):
                out.add(w)
            out.update([r for r in _RUN.findall(w) if len(r) <= LONGEST or not _KANA.search(r)])
    if plain:
        return {t for t in out if from_utf8(t)}
    last = len(text) - WINDOW
    for m in _WORD.finditer(text) if at else ():
        if m.end() - m.start() > PIECE:  # half the length of what goes by pieces
            inside = at[bisect_left(at, m.start()) : bisect_left(at, m.end())]
            out.update([text[i : i + PIECE] for i in {k for j in inside for k in range(max(m.start(), j - PIECE + 1), min(j, m.end() - PIECE) + 1)}])
    out.update([text[i : i + WINDOW] for i in {k for j in at for k in range(max(0, j - WINDOW + 1), min(j, last) + 1)}])
    return out


def distinctive(form: str, word: str, used: set[str], chain: tuple[tuple[str, str], ...]) -> bool:
    """Whether a garbled form can be told from clean text."""
    if form == word or not form.strip() or form.isascii():
        return False
    lossy = "�" in form
    strange = odd(form, used) > 0
    if chain[0][0] != "utf-8" and not lossy and chain[-1][1] == "utf-8":
        return False  # strictly decoded from UTF-8: that mends text
    if len(form) < 2:
        return lossy
    if chain[0][0] == "utf-8":
        return lossy or strange or ungarble(form, chain) == word
    return (lossy or strange) and (lossy or len(form) > 2 or any(c.isascii() and c.isalpha() for c in form))


def fine(w: str, used: set[str]) -> bool:
    """Whether a word passes as clean: characters in use, common ones, half-width kana, Latin letters."""
    return all(c <= "\x7f" or c in used or common(c) or "\uff61" <= c <= "\uff9f" or (c.isalpha() and c < "\u0250") for c in w)


#: Chains of encodings that garble either way. From UTF-8, a form decodes strictly back and can be told.
EITHER_WAY = {name_of(c) for c in CHAINS if c[0][0] != "utf-8" and tuple((b, a) for a, b in reversed(c)) in CHAINS}


def contested(form: str, chain: str, used: set[str]) -> bool:
    """Whether a garbled form may as well be the clean word, and its original the garbled one."""
    return chain in EITHER_WAY and "�" not in form and fine(form, used)


def seven_bit_forms(word: str, name: str, chain: tuple[tuple[str, str], ...]) -> Iterator[tuple[str, str]]:
    """Of pairs and lone characters of Japanese in ISO-2022-JP, and of words without ASCII letters in UTF-7."""
    if any(c < "\x80" for c in word) or (chain[0][0] == "iso2022_jp" and (len(word) > 2 or not _KANA.match(word))):
        return
    form = garble(word, chain)
    if form is not None and form.isascii():
        if chain[0][0] == "utf-7":
            yield "+" + form.strip("+-") + "-", name
        elif form.startswith("$B") and form.endswith("(B") and len(form) == 4 + 2 * len(word):
            yield form if len(word) == 1 else form[:-2], name


def forms(word: str, used: set[str]) -> Iterator[tuple[str, str]]:
    """(garbled form, chain) of a clean word."""
    japanese = len(word) == 2 and _KANA.match(word) is not None
    narrow = any("\uff61" <= c <= "\uff9f" for c in word)
    for name, chain in CHAIN_OF.items():
        if chain[0][0] in _SEVEN_BITS:
            yield from seven_bit_forms(word, name, chain)
            continue
        form = garble(word, chain)
        if form is not None and narrow and len(word) < 3 and chain[0][0] != "utf-8" and "�" not in form:
            continue
        if form is None:
            continue
        if japanese:
            if any(d in _MULTI or d == "utf-8" for _, d in chain):
                form = form.strip("�") if "�" in form.strip("�") or chain[-1][1] != "utf-8" else form
            form = form[:WINDOW]
            if len(form) < WINDOW or sum(c > "\x7f" for c in form) < 2 or not ("�" in form or odd(form, used)):
                continue
            yield form, name
            continue
        if distinctive(form, word, used, chain):
            yield form, name
        if PIECE <= len(word) <= 2 * PIECE and len(form) > PIECE and ("�" in form[:PIECE] or odd(form[:PIECE], used)) and distinctive(form[:PIECE], word[:PIECE], used, chain):
            yield form[:PIECE], name


def _texts(df: DataFrame) -> DataFrame:
    return df.where(F.col("text").isNotNull() & F.col("text").rlike(r"[^\x00-\x7F]|\$[B@][!-~]{2}|\+[A-Za-z0-9/]{3}"))


def texts(fields: DataFrame, attachments: DataFrame) -> DataFrame:
    """All texts to examine: src_table, row_id, slot, text."""
    f = fields.select(F.lit("doc_fields").alias("src_table"), F.col("field_id").cast("long").alias("row_id"), F.explode(F.concat(F.array(F.struct(F.lit("value").alias("slot"), F.col("value").alias("text"))), F.coalesce(F.transform("value_list", lambda x, i: F.struct(i.cast("string").alias("slot"), x.alias("text"))), F.array()))).alias("x"))
    a = attachments.select(F.lit("doc_attachments").alias("src_table"), F.col("att_id").cast("long").alias("row_id"), F.explode(F.array(F.struct(F.lit("name").alias("slot"), F.col("name").alias("text")), F.struct(F.lit("saved_name").alias("slot"), F.col("saved_name").alias("text")))).alias("x"))
    return _texts(f.union(a).select("src_table", "row_id", "x.slot", "x.text"))


def repertoire(corpus: DataFrame, min_documents: int = MIN_DOCUMENTS) -> set[str]:
    """Non-ASCII characters that the reference corpus uses, in either case. At most as many as Unicode has."""
    chars = F.array_distinct(F.regexp_extract_all("text", F.lit(r"([^\x00-\x7F])"), F.lit(1)))
    rows = _texts(corpus).select(F.explode(chars).alias("c")).groupBy("c").agg(F.count("*").alias("n")).where(F.col("n") >= min_documents).collect()
    return {x for r in rows for x in (r["c"], *r["c"].lower(), *r["c"].upper()) if x > "\x7f"}


def clean_words(corpus: DataFrame, examined: DataFrame, used: set[str]) -> DataFrame:
    """Distinct clean words: word, trusted (from the reference corpus)."""

    def own(trusted: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                found: Counter[str] = Counter()
                for text in pdf["text"]:
                    found.update(_WORD.findall(text))
                count: Counter[str] = Counter()
                for w, n in found.items():
                    if not w.isascii():
                        for p in parts(w):
                            count[p] += n
                kept = [w for w in count if fine(w, used) or symbols(w)]
                yield pd.DataFrame({"word": pd.Series(kept, dtype=object), "trusted": [trusted and fine(w, used) for w in kept], "n": np.array([count[w] for w in kept], np.int64)})

        return run

    kind = "word string, trusted boolean, n long"
    both = _texts(corpus).select("text").mapInPandas(own(True), kind).union(examined.select("text").mapInPandas(own(False), kind))
    return both.groupBy("word").agg(F.max("trusted").alias("trusted"), F.sum("n").alias("n"))


def garbled_forms(clean: DataFrame, used: set[str]) -> DataFrame:
    """token, original, chain, n (of the original), contested: every garbled form of every clean word."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(form, word, chain, n, contested(form, chain, used)) for word, n in zip(pdf["word"], pdf["n"], strict=True) for form, chain in forms(word, used)]
            yield pd.DataFrame(out, columns=["token", "original", "chain", "n", "contested"])

    width = int(clean.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return clean.select("word", "n").repartition(width, "word").mapInPandas(run, "token string, original string, chain string, n long, contested boolean")


def counted_tokens(examined: DataFrame, used: set[str]) -> DataFrame:
    """token, times (in how many texts)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odd_ = odd_pattern(used)
        for pdf in batches:
            found: Counter[str] = Counter()
            for text, n in Counter(pdf["text"]).items():
                for token in tokens(text, odd_):
                    found[token] += n
            yield pd.DataFrame({"token": pd.Series(list(found), dtype=object), "times": np.array(list(found.values()), np.int64)})

    return examined.select("text").mapInPandas(run, "token string, times long").groupBy("token").agg(F.sum("times").alias("times"))


def seeker(names: Iterable[str]):
    """An automaton that gives all names that stand anywhere in a text."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for name in names:
        out.add_word(name, name)
    out.make_automaton()
    return out


def bytes_of(df: DataFrame, *columns: str) -> int:
    """What so many rows take, overhead included."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(100))
    return df.agg(F.sum(size.cast("long")).alias("n")).first()["n"] or 0


def distinct_texts(every: DataFrame, names: DataFrame, used: set[str]) -> DataFrame:
    """name, texts: how many distinct texts hold each of the names (tokens or clean words), exact up to its ``most``.

    A task reports at most so many texts of a name, and seeks a name no longer that it has reported so often.
    """
    few = bytes_of(names, "name") <= BROADCAST_BYTES
    shared = every.sparkSession.sparkContext.broadcast({r["name"]: r["most"] for r in names.collect()} if few else None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, odd_ = dict(shared.value) if few else {}, odd_pattern(used)
        held: dict[str, set[int]] = {name: set() for name in known}
        seek, width = None, 0
        for pdf in batches:
            out = []
            for text, h in dict(zip(pdf["text"], pdf["h"], strict=True)).items():
                if few:
                    if not known:
                        break
                    if 2 * len(known) <= width or seek is None:
                        seek, width = seeker(known), len(known)
                    # Tokens and words are pieces of the text, so others needn't be cut.
                    there = {name for _, name in seek.iter(text)} & known.keys()
                    if not there:
                        continue
                own = tokens(text, odd_).union(*(parts(w) for w in set(_WORD.findall(text)) if not w.isascii()))
                for name in there & own if few else own:
                    out.append((name, h))
                    if few:
                        held[name].add(h)
                        if len(held[name]) >= known[name]:
                            del known[name], held[name]
            yield pd.DataFrame(out, columns=["name", "h"])

    each = every.select("text", F.xxhash64("text").alias("h")).mapInPandas(run, "name string, h long")
    each = each if few else each.join(names, "name", "left_semi")
    return each.groupBy("name").agg(F.countDistinct("h").alias("texts"))


def matched_tokens(examined: DataFrame, corpus: DataFrame, clean: DataFrame, used: set[str]) -> DataFrame:
    """token, original, chain, originals (1, or 2 for more): hash join of the distinct tokens of the texts with the garbled forms.

    The tokens are the smaller side; they are broadcast if they are measured to be few. Of a contested form and
    its original, the one in far more distinct texts is clean; where as many hold either, the one in far more rows.
    """
    from folioforge.session import checkpoint

    own = checkpoint(counted_tokens(examined, used))
    clean = checkpoint(clean)
    few = bytes_of(own, "token") <= BROADCAST_BYTES
    hit = garbled_forms(clean, used).join(F.broadcast(own) if few else own, "token")
    hit = checkpoint(hit.select("token", "original", "chain", "contested", "times", (F.col("times") > F.col("n") * FREQUENT).alias("rows")))
    pairs = hit.where("contested")
    if not pairs.isEmpty():
        # A token is in at most ``times`` distinct texts; whether its original is in more needn't be counted further.
        names = pairs.select(F.explode(F.array("token", "original")).alias("name"), (F.col("times") + 1).alias("most"))
        names = checkpoint(names.groupBy("name").agg(F.max("most").alias("most")))
        number = checkpoint(distinct_texts(examined.select("text").union(_texts(corpus).select("text")), names, used))
        as_ = lambda name, n: number.select(F.col("name").alias(name), F.col("texts").alias(n))
        pairs = pairs.join(as_("token", "a"), "token").join(as_("original", "b"), "original")
        pairs = pairs.where(~((F.col("a") > F.col("b") * FREQUENT) | ((F.col("a") == F.col("b")) & F.col("rows")))).select(hit.columns)
        hit = hit.where("not contested").union(pairs)
    table = hit.groupBy("token").agg(F.min(F.struct("chain", "original")).alias("m"), F.when(F.min("original") == F.max("original"), 1).otherwise(2).cast("long").alias("originals"))
    trusted = clean.where("trusted").select(F.col("word").alias("token"))
    return table.join(trusted, "token", "left_anti").select("token", "m.original", "m.chain", "originals")


def affected(examined: DataFrame, corpus: DataFrame, used: set[str] | None = None) -> DataFrame:
    """src_table, row_id, slot, text, hits (token, original, chain, originals) of the affected texts."""
    from folioforge.session import checkpoint

    spark = examined.sparkSession
    used = repertoire(corpus) if used is None else used
    matched = checkpoint(matched_tokens(examined, corpus, clean_words(corpus, examined, used), used))
    out = "src_table string, row_id long, slot string, text string, hits array<struct<token:string,original:string,chain:string,originals:long>>"
    if bytes_of(matched, "token", "original", "chain") <= BROADCAST_BYTES:
        shared = spark.sparkContext.broadcast({r["token"]: (r["token"], r["original"], r["chain"], r["originals"]) for r in matched.collect()})

        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = shared.value
            keys, odd_ = known.keys(), odd_pattern(used)
            for pdf in batches:
                cache = {t: [known[k] for k in sorted(keys & tokens(t, odd_))] for t in set(pdf["text"])}
                hits = pdf["text"].map(cache)
                pdf = pdf.assign(hits=hits)
                yield pdf[hits.map(len) > 0]

        return examined.mapInPandas(probe, out)

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odd_ = odd_pattern(used)
        for pdf in batches:
            pdf = pdf.assign(token=[sorted(tokens(t, odd_)) for t in pdf["text"]])
            yield pdf.explode("token").dropna(subset=["token"])

    each = examined.mapInPandas(explode, "src_table string, row_id long, slot string, text string, token string")
    return each.join(matched, "token").groupBy("src_table", "row_id", "slot", "text").agg(F.collect_set(F.struct("token", "original", "chain", "originals")).alias("hits"))


def _mend_seven_bit(text: str, written: set[str], known: set[str]) -> str:
    def jis(m: re.Match) -> str:
        if not seven_bit(m.group()) & known:
            return m.group()
        try:
            return b"".join((b"\x1b$B", m.group(1).encode("ascii"), b"\x1b(B")).decode("iso2022_jp")
        except UnicodeError:
            return m.group()

    def seven(m: re.Match) -> str:
        try:
            return f"+{m.group(1)}-".encode("ascii").decode("utf-7") if f"+{m.group(1)}-" in known else m.group()
        except UnicodeError:
            return m.group()

    if "iso2022_jp" in written:
        text = _JIS.sub(jis, text)
    return _SEVEN.sub(seven, text) if "utf-7" in written else text


def mend(text: str, hits: list[tuple[str, str, str, int]], used: set[str]) -> str:
    """The text with its garbled parts put back as far as they can be."""
    # The same bytes may be UTF-8 and Japanese; UTF-8 asks for more, so it comes first.
    chains = sorted({CHAIN_OF[h[2]] for h in hits}, key=lambda c: (c[0][0] != "utf-8", -len(c), name_of(c)))
    # A token may come out of several chains, of which the table keeps one; those from UTF-8 can be told by decoding.
    if any(c[0][0] in _SEVEN_BITS for c in chains):
        text = _mend_seven_bit(text, {c[0][0] for c in chains}, {h[0] for h in hits})
        chains = [c for c in chains if c[0][0] not in _SEVEN_BITS]
    chains += [c for c in CHAINS if c[0][0] == "utf-8" and c[0][1] in _SINGLE and c not in chains]
    single = {h[0]: h[1] for h in hits if h[3] == 1}

    def part(piece: str) -> str:
        best = piece
        for chain in chains:
            back = ungarble(piece, chain)
            if back is not None and (odd(back, used), len(back)) < (odd(best, used), len(best)):
                best = back
        return best

    whole = part(text)
    if whole != text and odd(whole, used) == 0:
        return whole
    out = []
    for piece in re.split(r"([\x00-\x20]+)", text):
        mended = part(piece) if not piece.isascii() else piece
        if mended == piece and _KANA.search(piece):  # clean and garbled text in one run
            mended = _NARROW.sub(lambda m: part(m.group()), piece)
        if mended == piece and not piece.isascii():
            mended = _WORD.sub(lambda m: single.get(m.group()) or _RUN.sub(lambda r: part(r.group()) if part(r.group()) != r.group() else single.get(r.group(), r.group()), part(m.group())), piece)
        out.append(mended)
    return "".join(out)


def restore(examined: DataFrame, corpus: DataFrame) -> DataFrame:
    """src_table, row_id, slot, text, mended, restored (nothing garbled is left), chains."""
    used = repertoire(corpus)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            hits = [[(h["token"], h["original"], h["chain"], h["originals"]) for h in row] for row in pdf["hits"]]
            mended = [mend(t, h, used) for t, h in zip(pdf["text"], hits, strict=True)]
            done = [m != t and "�" not in m and not any(h[0] in m for h in hs) for m, t, hs in zip(mended, pdf["text"], hits, strict=True)]
            yield pdf.assign(mended=mended, restored=done, chains=[", ".join(sorted({h[2] for h in hs})) for hs in hits])[["src_table", "row_id", "slot", "text", "mended", "restored", "chains"]]

    return affected(examined, corpus, used).mapInPandas(run, "src_table string, row_id long, slot string, text string, mended string, restored boolean, chains string")


def corpus_of(documents: DataFrame, people: DataFrame) -> DataFrame:
    """Reference texts: documents and the name directory."""
    names = people.select(F.concat_ws(" ", "given", "family").alias("text"))
    # Twice, as names count even where only one person bears them.
    return documents.select(F.col("text").cast("string").alias("text")).union(names).union(names)


def found(fields: DataFrame, attachments: DataFrame, documents: DataFrame, people: DataFrame) -> DataFrame:
    """src_table, row_id of the affected rows."""
    return affected(texts(fields, attachments), corpus_of(documents, people)).select("src_table", "row_id").distinct()
