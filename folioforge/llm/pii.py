"""Personal information in free text, by a skip-chain conditional random field.

Texts are cut into tokens (an e-mail address, a number or a code is one token; kanji stand alone). A linear chain scores
each token by its own form, by the name directory, by kinds of cue words near it (titles, words for identity papers,
telephones, addresses, tickets and invoices, in all languages), by how rare it and its neighbours are, and by the shapes
around it. Tokens of a document that repeat the same or a similar rare or listed word, or pair of kanji, are joined by
skip edges that favour equal labels. Marginals come from loopy message passing: exact forward-backward on the chain,
then messages along the skip edges, a fixed number of rounds; each token takes its most likely label.

The weights are learned here, from a bounded sample of ``TRAIN_TEXTS`` texts chosen by hash. Its labels are made by the
written forms of addresses, numbers and e-mail, by kinds of cue words and by the name directory. So that the field
learns more than these rules, part of the sample is used again with every mention replaced by an invented one (names of
random syllables or kanji, numbers and addresses of random make), with ordinary words made unknown, with directory
entries hidden, and with invented mentions put between the words of any sentence. The fit runs on an executor; the model
is some MB and is broadcast; every text is labelled whole.

A directory of at most ``DIRECTORY_BYTES`` is broadcast; a larger one is joined with the words of the texts by shuffle.

Defined results: null and empty texts hold no mention; repeated rows are reported each under their own id; a mention is
reported at its first character, from 1, without title, honorific or role; without any text nothing is learned.
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_TEXTS = 5000
#: Rows, as many times the sample, that it is drawn from.
SAMPLE_FACTOR = 8
#: What a directory may take, as counted, to be broadcast.
DIRECTORY_BYTES = 32 << 20
ROUNDS = 3
#: Cached sums per worker; beyond them the cache starts anew.
CACHE_ROWS = 1_000_000
#: Cells (form, class, mark) and classes that the caches number before they start anew.
CELLS, CLASSES = 1 << 15, 128
EPOCHS = 6
#: Added to the score for a name of an unknown capitalised word beside another.
UNKNOWN_PAIR = 1.0
#: Tokens to the left and right within which a cue word counts.
CUE_LEFT, CUE_RIGHT = 8, 3
ITEMS = ("Body", "Comment", "Remarks")
LABELS = ("O", "name", "email", "phone", "id_number", "address")
O, NAME, EMAIL, PHONE, IDNUM, ADDRESS = range(6)
PLACEHOLDER = {NAME: "[NAME]", EMAIL: "[EMAIL]", PHONE: "[PHONE]", IDNUM: "[ID]", ADDRESS: "[ADDRESS]"}

_MAIL = r"[A-Za-z0-9０-９Ａ-Ｚａ-ｚ][A-Za-z0-9._%+\-０-９Ａ-Ｚａ-ｚ．]*(?:\s?[@＠]\s?|\s?[\[({](?:at|AT|At)[\])}]\s?)[A-Za-z0-9０-９Ａ-Ｚａ-ｚ\-]+(?:(?:[.．]|\s?[\[({](?:dot|DOT|Dot)[\])}]\s?)[A-Za-z0-9０-９Ａ-Ｚａ-ｚ\-]+)+"
_CODE = r"(?<![A-Za-z0-9])(?:[A-Z]{2} \d{6,8}|[A-Z]{2}(?: \d{2}){3} [A-Z]|(?=[A-Z0-9\-]*\d)(?=[A-Z0-9\-]*[A-Z])[A-Z0-9]+(?:-[A-Z0-9]+)*)(?![A-Za-z0-9])"
_NUMBER = r"(?:[+＋]\s?)?(?:[(（]\d{1,5}[)）]\s?)?\d+(?:(?:\s?/\s?|[ \xa0.\-–－]|\s?\(\d{1,4}\)\s?|)\d+)*"
_TOKEN = re.compile(rf"(?P<mail>{_MAIL})|(?P<code>{_CODE})|(?P<num>{_NUMBER})|(?P<word>[A-Za-zÀ-ɏ]+)|(?P<han>[一-鿿々ヶ])|(?P<kata>[ァ-ヴー]+)|(?P<san>さん|さま)|(?P<hira>[ぁ-ん]+?(?=さん)|[ぁ-ん]+)|(?P<nl>\n+)|(?P<other>[^\s])")

# Titles, honorifics and roles before a name; they don't belong to it.
TITLES = "herr herrn frau dr prof ing mr mrs ms miss sir mme mlle monsieur madame m sr sra srta señor señora senhor senhora d dña don doña dom dona sig ra signor signora dott ssa dhr mevr mevrouw meneer mw ª"
_TITLES = frozenset(TITLES.split())
# Signs that are classes of their own.
_MARKS = frozenset("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~。、「」『』（）：；・〒～！？–—“”‘’„«»…")
# What follows a Japanese name.
_HONORIFICS = frozenset("さん さま 様 氏 殿 君".split())
# Words by which a French text is told, where M. is a title.
_FRENCH = frozenset("les des une du au dans pour aux ne pas qui est et le selon ou à".split())

# Beginnings of words that tell what a number or name near them is, by kind, in all languages:
# I identity papers, P telephones, R other numbers and things with names, A addresses, N roles of people.
CUES = {
    "I": "ausweis personalausweis reisepass führerschein steuer-?id sozialversicherungs passport identi licen[cs]e id$ ssn cni pièce papiers dni nie nif documento doc$ pasaporte passaporto passaporte passeport codice patente cédula cpf bsn paspoort rijbewijs sofi パスポート マイナンバー",
    "P": "tel$ telef telep télép phone mobil handy ruf rufe anruf rückruf erreich call calling dial ring fax appel appeler joindre portable llam móvil chiam cellul ligar ligue liga telem bel$ belt bellen gebeld gsm",
    "R": "vorgang ticket dossier expediente processo pratica rechnung invoice factur fattura fatura bestell order pedido commande ordine encomenda unid build version release runs server host port ip akten file case konto account référence referen index counter raum room salle sala zaal hall projekt project projet proyecto progetto projeto system database datenbank",
    "A": "adress address anschrift direcc domicilio indirizzo endereço morada adres wohn lives live resid habite demeur vive abita mora woont deliver liefer livr entreg entrega consegn bezorg zugestell",
    "N": "ansprechpartner antragsteller sachbearbeiter kontakt contact applicant demandeur responsable solicitante interesado richiedente referente requerente aanvrager contactpersoon colleague kolleg collègue compañer collega colega",
}
_CUE = {k: re.compile("|".join(v.split())) for k, v in CUES.items()}
# The same kinds in Japanese, where cues aren't words of their own.
_JA_CUE = re.compile("(?P<I>身分証|旅券|免許|本人確認|個人番号|証明書|保険証)|(?P<P>電話|携帯|内線|連絡先番号)|(?P<R>受付|請求|伝票|注文|案件|文書|整理番号|会議室|号室)|(?P<A>住所|所在地|送付先|宛先|届け先|配送先|居住)|(?P<N>担当|申請者|連絡先|氏名|責任者|依頼者)")
_REF = re.compile(r"(?:\b[A-Z]{2,4}-\d{4}-|\d+-\d+-\d+-)")

# Kinds of streets, as words before or after a name and as endings of it.
STREETS = {
    "en": "street st road rd lane ln avenue ave drive dr court ct close way square sq grove place pl crescent terrace gardens hill row mews walk boulevard blvd park green",
    "de": "straße strasse str gasse weg allee platz damm ufer ring steig pfad chaussee graben wall stieg",
    "fr": "rue chemin avenue av boulevard bd place quai impasse allée cours route square passage sentier faubourg villa",
    "es": "c calle avda avenida plaza paseo pza camino ronda carrera travesía glorieta cuesta callejón",
    "it": "via viale piazza p corso vicolo largo v strada piazzale lungomare salita contrada",
    "pt": "rua r travessa av avenida largo praça estrada alameda beco calçada ladeira",
    "nl": "straat laan gracht plein kade dijk singel weg pad steeg dreef wal hof",
}
_TAILED = tuple(x for k in ("de", "nl") for x in STREETS[k].split() if len(x) > 2)
_STREET_WORDS = frozenset(x for v in STREETS.values() for x in v.split() if len(x) > 1)

_CAP = r"[A-ZÀ-ÖØ-ÞŁ][A-Za-zÀ-ɏ’\-]*"
_LINK = r"(?:(?:de|du|des|del|della|dei|delle|di|da|do|das|dos|la|le|las|los|el|l'|d')\s?)*"


def _street_forms() -> re.Pattern:
    """Written forms of street addresses, for the labels of the sample."""
    words = {k: "|".join(sorted(map(re.escape, v.split()), key=len, reverse=True)) for k, v in STREETS.items()}
    title = {k: "|".join(sorted((re.escape(w.capitalize()) for w in v.split()), key=len, reverse=True)) for k, v in STREETS.items()}
    ending = "|".join(w for k in ("de", "nl") for w in STREETS[k].split())
    number = r"\d{1,4} ?[a-z]?\b"
    return re.compile("|".join(f"(?:{p})" for p in (
        rf"\d{{1,4}}[a-z]?,? (?:{_CAP} ){{1,3}}(?:{title['en']})\b\.?(?:, (?:Flat|Apt\.?|Unit) \d+)?(?:, {_CAP}(?: {_CAP})?(?: \d{{5}})?)?",
        rf"(?:\d{{5}} {_CAP}, )?(?:(?:Alte[rn]?|Am|An der|Im|Zum|Zur|Neue[rn]?) )?{_CAP}(?:[- ](?:{title['de']})\b\.?|(?:{ending})\.?) {number}(?:, \d{{4,5}}(?: [A-Z]{{2}})? {_CAP})?",
        rf"\d{{1,4}}(?: bis| ter)?,? (?:{words['fr']})\b\.? {_LINK}[A-ZÀ-Þ][\wÀ-ÿ'’\-]*(?: [A-ZÀ-Þ][\wÀ-ÿ'’\-]*)*(?:, \d{{5}} [A-ZÀ-Þ][\wÀ-ÿ\-]*)?",
        rf"(?:C/|(?:{title['es']})\b\.?) ?{_LINK}(?:{_CAP} )*{_CAP},? (?:n\.º )?\d+(?:, ?\d{{5}} {_CAP}(?: {_CAP})*)?",
        rf"(?:{title['it']}|P\.za|V\.le)\b\.? {_LINK}(?:{_CAP} )*{_CAP},? (?:n\. )?\d+(?:, \d{{5}} {_CAP}(?: {_CAP})*)?",
        rf"(?:{title['pt']})\b\.? {_LINK}(?:{_CAP} )*{_CAP},? (?:n\.º )?\d+(?:, (?:\d{{4}}(?:-\d{{3}})? )?{_CAP}(?: {_CAP})*)?",
        r"(?:〒\s?\d{3}[-－]\d{4}\s?)?[一-鿿々ヶ]{1,4}[都道府県][一-鿿々ヶ]{1,6}[市区郡][一-鿿々ヶ]{0,8}\s?\d+(?:丁目\d+番\d+号|(?:[-－]\d+){1,2})?",
    )))


_STREET = _street_forms()
_DATE = re.compile(r"^(?:\d{1,2}[./-]\d{1,2}[./-]\d{2,4}|\d{4}[./-]\d{1,2}[./-]\d{1,2})$")
_NET = re.compile(r"^\d{1,3}(?:\.\d{1,5}){2,3}$")


class Directory:
    """Names, lower case, and how family names begin and end."""

    def __init__(self, rows: list[tuple[str | None, str | None]]):
        given, family = ({x for r in rows for x in [r[i]] if x} for i in (0, 1))
        self.given, self.family = {g.casefold() for g in given}, {f.casefold() for f in family}
        latin = [f for f in self.family if f[0] < "⺀" and len(f) >= 7]
        self.heads, self.tails = {f[:3] for f in latin}, {f[-4:] for f in latin}
        self.kanji = {g: 1 for g in given if g[0] >= "⺀"} | {f: 2 for f in family if f[0] >= "⺀"}
        self.longest = max(map(len, self.kanji), default=0)
        self.cells: dict[tuple[str, str], tuple] = {}
        self.vocabulary: dict[str, int] = {}
        self.partial = False

    def rarity(self, word: str) -> str:
        """0 to 2 and +: in how many sampled texts a word is."""
        n = self.vocabulary.get(word, 0)
        return "0" if n == 0 else "1" if n < 3 else "2" if n < 8 else "+"

    def __getstate__(self):
        return self.__dict__ | {"cells": {}}

    def kind(self, word: str) -> str:
        w = word.casefold()
        return ("g" if w in self.given else "") + ("f" if w in self.family else "") or ("l" if len(w) >= 6 and w[:3] in self.heads and w[-4:] in self.tails else "-")


def cue(word: str) -> str:
    """Kind of cue word, t for titles, s for streets, or a dash."""
    if word in _TITLES:
        return "t"
    if word in _STREET_WORDS or (len(word) > 6 and word.endswith(_TAILED)):
        return "s"
    return next((k for k, p in _CUE.items() if p.match(word)), "-")


def describe(kind: str, form: str, names: Directory) -> tuple[str, str, str, str | None, str, str]:
    """(form, class, directory mark, key of skip edges, kind of cue, rarity) of a token."""
    mark = tag = rare = "-"
    key = None
    if kind == "word":
        cls = "init" if len(form) == 1 and form.isupper() else "UP" if form.isupper() else "cap" if form[0].isupper() else "low"
        mark = names.kind(form)
        form = form.casefold()
        tag, rare = cue(form), names.rarity(form)
        if len(form) > 1 and (mark != "-" or (rare in "01" and cls != "low")):
            key = form[:-1] if len(form) > 4 and form[-1] == "s" else form
    elif kind == "num":
        digits = sum(map(str.isdigit, form))
        lead = "+" if form[0] in "+＋" else "(" if form[0] in "(（" else "00" if form.startswith("00") else "0" if form[0] in "0０" else "1"
        shape = re.sub(r"\d", "9", form) if digits >= 5 else "9"
        cls = f"n{lead}{min(digits, 14)}" if digits >= 5 else "n"
        form = shape.replace("－", "-").replace("–", "-")
    elif kind == "code":
        cls = "code" if len(form) <= 20 else "code-long"
        form = re.sub("[A-Z]", "A", re.sub(r"\d", "9", form)) if len(form) <= 20 else "code-long"
    elif kind == "mail":
        form, cls, tag = "mail", "mail", "E"
    elif kind == "other":
        cls = form if form in _MARKS else "sym"
    elif kind == "nl":
        form = cls = "nl"
    else:
        cls = kind
        tag = cue(form) if kind == "kata" else "-"
    return form, cls, mark, key, tag, rare


class Tokens:
    """Tokens of a text with what the features need: form, class, directory mark, kind of cue, rarity, place."""

    __slots__ = ("begin", "end", "form", "cls", "mark", "key", "tag", "rare")

    def __init__(self, text: str, names: Directory):
        known, spans, cells = names.cells, [], []
        for m in _TOKEN.finditer(text):
            own = (m.lastgroup, m.group())
            cell = known.get(own)
            if cell is None:
                if len(known) > CACHE_ROWS // 4:
                    known.clear()
                cell = known[own] = describe(*own, names)
            spans.append(m.span())
            cells.append(cell)
        self.begin, self.end = [b for b, _ in spans], [e for _, e in spans]
        self.form, self.cls, self.mark, self.key, self.tag, self.rare = map(list, zip(*cells, strict=True)) if cells else ([] for _ in range(6))
        if "han" in self.cls:
            self._kanji(text, names)

    def _kanji(self, text: str, names: Directory) -> None:
        """Mark the longest directory entries among kanji; these and rare pairs of kanji are keys of skip edges."""
        n, i = len(self.form), 0
        for j in range(n - 1):
            if self.cls[j] == self.cls[j + 1] == "han" and self.begin[j + 1] == self.end[j]:
                pair = self.form[j] + self.form[j + 1]
                self.rare[j] = names.rarity(pair)
                if self.rare[j] in "01":
                    self.key[j] = pair
        if m := _JA_CUE.search(text):
            at = 0
            for m in _JA_CUE.finditer(text, m.start()):
                while at < n and self.end[at] <= m.start():
                    at += 1
                k = at
                while k < n and self.begin[k] < m.end():
                    self.tag[k] = m.lastgroup
                    k += 1
        while i < n:
            if self.cls[i] != "han":
                i += 1
                continue
            for k in range(min(names.longest, n - i), 1, -1):
                if self.end[i + k - 1] - self.begin[i] == k and (found_ := names.kanji.get("".join(self.form[i : i + k]))):
                    letter = "g" if found_ == 1 else "f"
                    for j in range(k):
                        self.mark[i + j] = letter + ("B" if j == 0 else "I")
                    self.key[i] = "".join(self.form[i : i + k])
                    i += k
                    break
            else:
                i += 1

    def contexts(self) -> list[tuple]:
        """Of each token: class, cues before and after it, whether a sentence begins, shapes, marks and rarity around it.

        The cue before a number is the last word for papers, telephones or other things, else, as for words, the last
        of any kind.
        """
        n = len(self.form)
        left, right = ["-"] * n, ["-"] * n
        now, age, firm, firm_age = "-", 0, "-", 0
        for i, (tag, cls) in enumerate(zip(self.tag, self.cls, strict=True)):
            left[i] = firm if firm != "-" and numeric(cls) else now
            age, firm_age = age + 1, firm_age + 1
            if tag != "-":
                if tag != "E":
                    now, age = tag, 0
                if tag in "IPRE":
                    firm, firm_age = tag, 0
                elif tag == "N":
                    firm = "-"
            if cls in ("nl", "。", ";") or age > CUE_LEFT:
                now = "-"
            if cls in ("nl", "。", ";") or firm_age > CUE_LEFT:
                firm = "-"
        now, age = "-", 0
        for i in range(n - 1, -1, -1):
            near = self.tag[i + 1] if i + 1 < n else "-"
            right[i] = "s" if near == "s" else now
            if self.tag[i] in "IPRAN":
                now, age = self.tag[i], 0
            elif self.cls[i] in ("nl", "。", ";", ".") or age >= CUE_RIGHT:
                now = "-"
            else:
                age += 1
        cls, mark, rare = (["^", *x, "^"] for x in (self.cls, self.mark, self.rare))
        start = ["^", "nl", ".", "!", "?", "。"]
        return [(cls[i], left[i - 1], right[i - 1], cls[i - 1] in start, cls[i - 1], cls[i + 1], mark[i - 1], mark[i], mark[i + 1], rare[i - 1], rare[i], rare[i + 1]) for i in range(1, n + 1)]


def numeric(cls: str) -> bool:
    """A number of five digits or more, or a code."""
    return cls[0] == "n" and cls not in ("n", "nl") or cls == "code"


def weak_labels(text: str, t: Tokens) -> list[int]:
    """Labels of a sampled text by written forms, cues and directory marks."""
    out = [O] * len(t.form)
    for m in _STREET.finditer(text):
        for i, (b, e) in enumerate(zip(t.begin, t.end, strict=True)):
            if b >= m.start() and e <= m.end():
                out[i] = ADDRESS
    latin = ("cap", "UP", "low", "init")
    left = [c[1] for c in t.contexts()]
    french = sum(f in _FRENCH for f in t.form) > 1
    for i, cls in enumerate(t.cls):
        if out[i]:
            continue
        own = text[t.begin[i] : t.end[i]]
        if cls == "mail":
            out[i] = EMAIL
        elif numeric(cls):
            digits = sum(map(str.isdigit, own))
            near = left[i]
            if near == "R" or _DATE.match(own) or _REF.match(own) or (_NET.match(own) and not (digits == 10 and near == "P")):
                continue
            if near == "I" and not (cls != "code" and cls[1] in "+(" and digits >= 8):
                out[i] = IDNUM
            elif cls != "code" and digits >= 8 and (cls[1] in "+(" or cls.startswith("n00") or near == "P" or any(out[j] in (PHONE, EMAIL) for j in range(max(0, i - 3), i))):
                out[i] = PHONE
            elif near in ("N", "t") and (cls == "code" or digits >= 7):
                out[i] = IDNUM
        elif cls in ("cap", "UP") and t.mark[i] != "-":
            out[i] = NAME
        elif cls == "han" and t.mark[i] != "-":
            out[i] = NAME
        elif cls == "low" and t.mark[i] in ("g", "f", "l") and any(0 <= j < len(t.form) and t.mark[j] in ("g", "f", "l") and t.mark[j] != t.mark[i] for j in (i - 1, i + 1)):
            out[i] = NAME
    # Capitalised words beside a first name or after a title, initials before a name, the comma inside "Family, Given".
    for i, cls in enumerate(t.cls):
        if out[i] or cls not in latin:
            continue
        follows = i and t.begin[i] == t.end[i - 1] + 1
        titled = follows and (t.form[i - 1] in _TITLES and t.form[i - 1] not in ("m", "d") or i > 1 and t.form[i - 1] == "." and t.form[i - 2] in _TITLES and t.cls[i - 2] != "init")
        dotted = i + 2 < len(out) and t.form[i + 1] == "."
        if cls in ("cap", "UP") and len(t.form[i]) > 3 and follows and t.mark[i - 1].startswith("g") and out[i - 1] == NAME and t.form[i] not in _TITLES:
            out[i] = NAME
        elif cls in ("cap", "UP") and len(t.form[i]) > 3 and titled and t.form[i] not in _TITLES:
            out[i] = NAME
        elif cls == "init" and dotted and (out[i + 2] == NAME or t.cls[i + 2] in ("cap", "UP") and t.mark[i + 2] != "-"):
            # A French M. before a family name alone is a title, before a first name and in other languages an initial.
            honorific = t.form[i] == "m" and (t.mark[i + 2] == "g" or french)
            if not honorific and not (t.form[i] == "d" and t.mark[i + 2] == "g"):
                out[i] = out[i + 1] = NAME
    for i in range(1, len(out) - 1):
        if t.form[i] == "," and out[i - 1] == NAME and out[i + 1] == NAME and t.mark[i + 1].startswith("g") and not t.mark[i - 1] == "g":
            out[i] = NAME
    # A single given name that is also an ordinary word stays; kanji only beside a cue.
    for i, cls in enumerate(t.cls):
        if out[i] == NAME and cls == "han":
            left = i
            while left and out[left - 1] == NAME and t.cls[left - 1] == "han":
                left -= 1
            right = i
            while right + 1 < len(out) and out[right + 1] == NAME and t.cls[right + 1] == "han":
                right += 1
            about = text[max(0, t.begin[left] - 4) : t.begin[left]] + "|" + text[t.end[right] : t.end[right] + 4]
            if right == left or not re.search(r"さん|様|氏|殿|先生|担当の|申請者|連絡先|\|[ 　][一-鿿]|[一-鿿][ 　]\||までお|さま", about):
                for j in range(left, right + 1):
                    if out[j] == NAME:
                        out[j] = -NAME
    return [max(0, x) for x in out]


def _lowered(text: str, names: Directory) -> str:
    """The text with each first name and the family name after it in lower case."""
    return re.sub(rf"({_CAP}) ({_CAP})", lambda m: m.group().lower() if names.kind(m.group(1)) == "g" and names.kind(m.group(2)) in ("f", "l") else m.group(), text)


OFFSETS = (-3, -2, -1, 1, 2, 3)


def own_features(form: str, cls: str, mark: str) -> list[str]:
    out = [f"c={cls}", f"w={form}", f"m={mark}|{cls}"]
    if cls in ("cap", "UP", "low"):
        out += [f"p3={form[:3]}|{cls}", f"p4={form[:4]}|{cls}", f"s3={form[-3:]}|{cls}", f"s4={form[-4:]}|{cls}", f"s5={form[-5:]}|{cls}"]
    elif cls == "hira":
        out += [f"p2={form[:2]}", f"s1={form[-1:]}"]
    return out


def near_features(offset: int, cls: str, form: str, other: str, mark: str) -> list[str]:
    out = [f"{offset}w={form}|{cls}", f"{offset}c={other}|{cls}", f"{offset}m={mark}|{cls}"]
    if numeric(cls):
        out.append(f"{offset}w={form}|number")  # a cue word counts for numbers of every shape
    return out


def context_features(cls: str, left: str, right: str, start: bool, before: str, after: str, m1: str, m2: str, m3: str, r1: str, r2: str, r3: str) -> list[str]:
    """Features of an entry of ``Tokens.contexts``: none of them names a word."""
    kind = "number" if numeric(cls) else cls
    out = [f"l={left}|{kind}", *([f"l={left}|{cls}"] if kind != cls else []), f"q={right}|{kind}", f"b={start}|{cls}|{after}", f"h={before}|{cls}|{after}", f"mm={m1}|{m2}|{m3}|{kind}"]
    if r2 != "-":
        out += [f"r={r2}|{cls}|{start}", f"rl={r2}|{left}|{cls}", f"rr={r1}{r2}|{before}|{cls}", f"rs={r2}{r3}|{cls}|{after}|{start}", f"r3={r1}{r2}{r3}|{before}|{cls}|{after}"]
    elif cls in ("n", "low", ",") or len(cls) == 1:
        out += [f"rx={r1}{r3}|{before}|{cls}|{after}"]
    return out


class Model:
    """Weights of the field and the caches of their sums."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, trans: np.ndarray, skip: float):
        self.index, self.weights, self.trans, self.skip = index, weights, trans, skip
        self._clear()

    def _clear(self) -> None:
        """Empty caches: numbers of cells (form, class, mark) and classes, and the rows of one table of sums of weights
        by cell, by (offset, cell there, class here) and by context."""
        self.cells: dict[tuple, int] = {}
        self.classes: dict[str, int] = {}
        self.class_of = np.zeros(CELLS, np.int64)
        self.own = np.full(CELLS, -1, np.int32)
        self.near: np.ndarray | None = None
        self.around: dict[tuple, int] = {}
        self.sums = np.zeros((1024, len(LABELS)), np.float32)
        self.used = 0

    def __getstate__(self):
        return {"index": self.index, "weights": self.weights, "trans": self.trans, "skip": self.skip}

    def __setstate__(self, state):
        for k, v in state.items():
            setattr(self, k, v)
        self._clear()

    def _row(self, names: list[str]) -> int:
        """Number of a new row with the sum of the weights of the features."""
        at = [self.index[x] for x in names if x in self.index]
        if self.used == len(self.sums):
            self.sums = np.concatenate((self.sums, np.zeros_like(self.sums)))
        if at:
            self.sums[self.used] = self.weights[at].sum(0)
        self.used += 1
        return self.used - 1

    def _numbers(self, cells: list[tuple]) -> np.ndarray | None:
        """Numbers of the cells; None if there are more than the caches can number."""
        known, classes = self.cells, self.classes
        out = np.empty(len(cells), np.int64)
        for i, cell in enumerate(cells):
            k = known.get(cell)
            if k is None:
                k = len(known)
                c = classes.setdefault(cell[1], len(classes))
                if k >= CELLS or c >= CLASSES:
                    return None
                known[cell] = k
                self.class_of[k] = c
                self.own[k] = self._row(own_features(*cell))
            out[i] = k
        return out

    def unary(self, texts: list[Tokens]) -> np.ndarray:
        """Scores of the labels of all tokens of the texts, one after the other."""
        if self.used > CACHE_ROWS:
            self._clear()
        edge = [("^", "^", "-")] * 3
        stream = list(edge)
        for t in texts:
            stream += zip(t.form, t.cls, t.mark, strict=True)
            stream += edge
        ids = self._numbers(stream)
        if ids is None:  # start anew; texts that are too much for empty caches go in halves
            self._clear()
            ids = self._numbers(stream)
            if ids is None:
                self._clear()
                if len(texts) > 1:
                    half = len(texts) // 2
                    return np.concatenate((self.unary(texts[:half]), self.unary(texts[half:])))
                return self._slow(texts[0])
        if self.near is None:
            self.near = np.full((len(OFFSETS), CELLS * CLASSES), -1, np.int32)
        size = np.array([len(t.form) for t in texts])
        at = np.arange(size.sum()) + 3 + 3 * np.repeat(np.arange(len(texts)), size)
        here = self.class_of[ids[at]]
        rows = np.empty((len(at), 2 + len(OFFSETS)), np.int64)
        rows[:, 0] = self.own[ids[at]]
        for k, o in enumerate(OFFSETS):
            key = ids[at + o] * CLASSES + here
            own = self.near[k][key]
            if (own < 0).any():
                first = np.unique(key[own < 0], return_index=True)[1]
                for i in np.flatnonzero(own < 0)[first]:
                    self.near[k, key[i]] = self._row(near_features(o, stream[at[i]][1], *stream[at[i] + o]))
                own = self.near[k][key]
            rows[:, 1 + k] = own
        around, i = self.around, 0
        for t in texts:
            for context in t.contexts():
                k = around.get(context)
                if k is None:
                    k = around[context] = self._row(context_features(*context))
                rows[i, -1] = k
                i += 1
        return self.sums[rows].sum(1)

    def _slow(self, t: Tokens) -> np.ndarray:
        """The scores without caches, for a text of very many different cells."""
        cells = [("^", "^", "-")] * 3 + list(zip(t.form, t.cls, t.mark, strict=True)) + [("^", "^", "-")] * 3
        out = np.zeros((len(t.form), len(LABELS)), np.float32)
        for i, context in enumerate(t.contexts()):
            names = own_features(*cells[i + 3]) + context_features(*context)
            for o in OFFSETS:
                names += near_features(o, cells[i + 3][1], *cells[i + 3 + o])
            if at := [self.index[x] for x in names if x in self.index]:
                out[i] = self.weights[at].sum(0)
        return out

    def label(self, texts: list[Tokens], cells: int = 120_000) -> list[np.ndarray]:
        """Most likely label of every token of every text."""
        out: list = [None] * len(texts)
        order = sorted(range(len(texts)), key=lambda i: len(texts[i].form))
        begin = 0
        while begin < len(order):
            stop = begin + 1
            while stop < len(order) and (stop - begin + 1) * len(texts[order[stop]].form) <= cells:
                stop += 1
            batch = [texts[i] for i in order[begin:stop]]
            for i, labels in zip(order[begin:stop], self._batch(batch), strict=True):
                out[i] = labels
            begin = stop
        return out

    def _batch(self, batch: list[Tokens]) -> list[np.ndarray]:
        size = np.array([len(t.form) for t in batch])
        longest = max(1, int(size.max()))
        unary = np.zeros((len(batch), longest, len(LABELS)), np.float32)
        unary[np.arange(longest)[None, :] < size[:, None]] = self.unary(batch)
        edges: list[tuple[int, int, int]] = []
        for b, t in enumerate(batch):
            seen: dict[str, int] = {}
            for i, k in enumerate(t.key):
                if k is not None:
                    if k in seen:
                        edges.append((b, seen[k], i))
                    seen[k] = i
        belief = marginals(unary, self.trans, size)
        if edges:
            rows = sorted({e[0] for e in edges})
            place = {b: k for k, b in enumerate(rows)}
            eb = np.array([place[e[0]] for e in edges])
            ei, ej = (np.array([e[k] for e in edges]) for k in (1, 2))
            pair = np.exp(self.skip * np.eye(len(LABELS)))
            to_j, to_i = (np.ones((len(edges), len(LABELS))) for _ in (0, 1))
            part = belief[rows]
            for _ in range(ROUNDS):
                from_i, from_j = part[eb, ei] / np.maximum(to_i, 1e-12), part[eb, ej] / np.maximum(to_j, 1e-12)
                new_j, new_i = from_i @ pair, from_j @ pair
                to_j, to_i = (x / x.sum(1, keepdims=True) for x in (np.sqrt(to_j * new_j), np.sqrt(to_i * new_i)))
                more = unary[rows].astype(np.float64)
                np.add.at(more, (eb, ej), np.log(np.maximum(to_j, 1e-12)))
                np.add.at(more, (eb, ei), np.log(np.maximum(to_i, 1e-12)))
                part = marginals(more, self.trans, size[rows])
            belief[rows] = part
        best = belief.argmax(2)
        return [best[b, :n] for b, n in enumerate(size)]


def marginals(unary: np.ndarray, trans: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Forward-backward of a batch of chains, padded at the end; probabilities per token."""
    b, n, labels = unary.shape
    peak = np.exp(unary.astype(np.float64) - unary.max(2, keepdims=True))
    step = np.exp(trans.astype(np.float64))
    live = np.arange(n)[None, :] < size[:, None]
    peak[~live] = 1.0
    alpha, beta = np.empty((b, n, labels)), np.ones((b, n, labels))
    alpha[:, 0] = peak[:, 0] / peak[:, 0].sum(1, keepdims=True)
    for i in range(1, n):
        a = (alpha[:, i - 1] @ step) * peak[:, i]
        alpha[:, i] = a / a.sum(1, keepdims=True)
    for i in range(n - 2, -1, -1):
        x = (beta[:, i + 1] * peak[:, i + 1]) @ step.T
        x /= x.sum(1, keepdims=True)
        beta[:, i] = np.where(live[:, i + 1, None], x, 1.0 / labels)
    out = alpha * beta
    return out / out.sum(2, keepdims=True)


# Syllables of invented names, patterns of invented numbers (L a letter, D a digit) and of telephones.
_SYLLABLES = "ba bel bo cas cla co da del dri du el en er fa fen fi ga gar gri ha hel hu il in jo ka kel ko la len li lo ma mer mi mo na nel no or pa per ra ren ri ro sa sel si so ta ter ti to ul va vel vi vo wa wil yo za zel".split()
_ENDINGS = "a o e n r s t an en er in on el al ar is us ez es ini ova ska sen son man berg stein feld mann ville eau ard ier eira inho ales ado ijk stra sma".split()
_PARTICLES = ["van ", "van der ", "von ", "de ", "de la ", "del ", "di ", "da ", "dos ", "Mc", "O'", "D'"]
_IDENTITY = "LLDDDDDD|LDDDDDDDD|DDDDDDDDL|DDDDDDDD-L|LDDDDDDDL|LL DDDDDDD|LLDDDDDDL|DDDDDDDDD|DDDDDDDDDD|DDDDDDDDDDD|DDD.DDD.DDD-DD|DDD-DD-DDDD|LDDLDDLDD|LLLLLLDDLDDLDDDL|D DD DD DD DDD DDD|DD DDD DDD DDD|DDDD DDDD DDDD|LL DD DD DD L|LDDDDDDDDDD|DDLLDDDDD|LDLDDLDDD".split("|")
_TELEPHONE = "+DD DD DDDD DDDD|+DD DDD DDDDDDD|+DDD DD DDD DDDD|+DD (D)DD DDD DD DD|+DDDDDDDDDDDD|00DD DD DDD DDDD|(0DDD) DDDDDD|(DDD) DDD-DDDD|0DDD DDDDDDD|0DDD/DDDDDD-DD|0D DD DD DD DD|0DD-DDDD-DDDD|0DD DDD DD DD|DDD DDD DDD|DDD-DDD-DDDD|0DDD-DDDDDD|DDD DD DD DD".split("|")
_OTHER = "DDDDDD|DDDD-DDDDDD|DDDDDDDD|LL-DDDD-DDDDDD|LLL-DDDDDD|DDDD-DDDD-DDDD|DDDDDDD|LDDDDDD|DD/DDDDDD".split("|")
_JA_LEVEL = [chr(c) for c in range(0x4E00, 0x9FA0) if chr(c).encode("cp932", "ignore")[:1] in {bytes([b]) for b in range(0x88, 0x99)}]


class Inventor:
    """Random mentions for training; what they are made of isn't taken from any text."""

    def __init__(self, seed: int, kanji: str):
        import random

        self.rng = random.Random(seed)
        #: Names hold the kanji of other words as well as rare ones.
        self.level = [_JA_LEVEL, sorted(set(kanji)) or _JA_LEVEL]

    def pattern(self, patterns: list[str]) -> str:
        letters, digits = "ABCDEFGHJKLMNPRSTVWXYZ", "0123456789"
        return "".join(self.rng.choice(letters) if c == "L" else self.rng.choice(digits) if c == "D" else c for c in self.rng.choice(patterns))

    def word(self, most: int = 3) -> str:
        out = "".join(self.rng.choice(_SYLLABLES) for _ in range(self.rng.randint(1, most))) + self.rng.choice(_ENDINGS)
        if self.rng.random() < 0.15:
            k = self.rng.randrange(len(out))
            out = out[:k] + self.rng.choice("äöüéèáíóúçãñøß") + out[k + 1 :]
        return out[0].upper() + out[1:]

    def kanji(self, least: int, most: int) -> str:
        return "".join(self.rng.choice(self.rng.choice(self.level)) for _ in range(self.rng.randint(least, most)))

    def name(self, japanese: bool, alone: bool = True, titled: bool = False) -> str:
        r = self.rng.random() * (0.25 if titled and not japanese else 1.0)
        if japanese:
            return self.kanji(2, 3) + self.rng.choice(["", "", " ", "　"]) + self.kanji(1, 3) if r < 0.7 or not alone else self.kanji(2, 3)
        given, family = self.word(2), self.word()
        if self.rng.random() < 0.12:
            given += "-" + self.word(2)
        if self.rng.random() < 0.1:
            family = self.rng.choice(_PARTICLES) + family
        elif self.rng.random() < 0.06:
            family += "-" + self.word()
        if alone and r < 0.12:
            return family if r < 0.08 else given
        return f"{given} {family}" if r < 0.7 else f"{given[0]}. {family}" if r < 0.8 else f"{family}, {given}" if r < 0.88 else f"{given} {self.word(1)[0]}. {family}" if r < 0.92 else f"{given} {self.word()} {family}"

    def address(self, japanese: bool) -> str:
        rng, n = self.rng, self.rng.randint(1, 299)
        if japanese:
            return (f"〒{self.pattern(['DDD-DDDD'])}" + rng.choice(["", " "]) if rng.random() < 0.4 else "") + self.kanji(2, 3) + rng.choice("都道府県県県") + self.kanji(1, 3) + rng.choice("市区郡市") + self.kanji(2, 4) + rng.choice([f"{n % 9 + 1}丁目{n % 30 + 1}番{n % 20 + 1}号", f"{n % 9 + 1}-{n % 30 + 1}-{n % 20 + 1}", f"{n}", f"{n % 9 + 1}丁目{n % 30 + 1}-{n % 20 + 1}"])
        style = rng.choice(sorted(STREETS))
        kind = rng.choice([w for w in STREETS[style].split() if len(w) > 1])
        own = self.word() + (" " + self.word() if rng.random() < 0.25 else "")
        city = self.word() + (" " + self.word() if rng.random() < 0.15 else "")
        code = self.pattern(["DDDDD", "DDDD LL", "DDDD-DDD", "DDDD"])
        tail = rng.choice(["", f", {city}", f", {code} {city}", f", {code} {city}", f" {code} {city}"])
        if style in ("de", "nl"):
            joined = own + kind if rng.random() < 0.7 and " " not in own else f"{own}-{kind.capitalize()}" if rng.random() < 0.4 else f"{own} {kind.capitalize()}"
            ahead = f"{code} {city}, " if rng.random() < 0.1 else ""
            return ahead + joined + ("." if kind == "str" else "") + f" {n}" + rng.choice(["", "", "", "a", " b"]) + ("" if ahead else tail)
        if style == "en":
            return f"{n}" + rng.choice(["", "", "", "b", ","]) + f" {own} {kind.capitalize()}" + ("." if len(kind) < 4 else "") + rng.choice([tail, f", {city}, {self.pattern(['LLD DLL', 'LD DLL', 'DDDDD'])}"])
        link = rng.choice(["", "", "de ", "de la ", "du ", "del ", "della ", "da ", "do ", "dos "])
        if style == "fr":
            return f"{n}" + rng.choice(["", "", ",", " bis"]) + f" {kind} {link}{own}{tail}"
        return f"{kind.capitalize()}" + ("." if len(kind) < 4 else "") + f" {link}{own}" + rng.choice([", ", " "]) + rng.choice(["", "", "n.º ", "n. "]) + f"{n}{tail}"

    def mention(self, kind: int, japanese: bool) -> str:
        return self.name(japanese) if kind == NAME else self.address(japanese) if kind == ADDRESS else self.pattern(_TELEPHONE) if kind == PHONE else self.pattern(_IDENTITY)

    def cue(self, kind: str, japanese: bool) -> str:
        if japanese:
            return self.rng.choice({"I": ["旅券番号", "身分証番号は", "免許証番号：", "個人番号 ", "保険証番号は"], "P": ["電話番号は", "携帯：", "電話", "内線 "], "R": ["受付番号", "請求書", "伝票番号は", "注文番号："]}[kind])
        word = self.rng.choice([w.rstrip("$").replace("-?", "-").replace("[cs]", "c") for w in CUES[kind].split() if w.isascii() or w[0] < "\u3000"])
        return self.rng.choice([word, word.capitalize(), word.capitalize(), word.upper() if len(word) < 5 else word]) + self.rng.choice([" ", ": ", " # ", " number ", " nr. ", "nummer ", " n° ", " es ", " is ", ". ", " é ", " ist "])


def replaced(text: str, spans: list[tuple[int, int, int]], inventor: Inventor) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with every mention but e-mail addresses replaced by an invented one, and the new spans."""
    out, new, at = "", [], 0
    for y, b, e in spans:
        out += text[at:b]
        own = text[b:e] if y == EMAIL else inventor.mention(y, re.search("[一-鿿]", text[b:e] if y in (NAME, ADDRESS) else text) is not None)
        new.append((y, len(out), len(out) + len(own)))
        out += own
        at = e
    return out + text[at:], new


def inserted(text: str, t: Tokens, labels: list[int], inventor: Inventor, named: bool = False) -> tuple[str, list[tuple[int, int, int]]] | None:
    """A piece of the text without mentions, with an invented one put between any two of its words."""
    rng = inventor.rng
    japanese = "han" in t.cls
    places = [i for i in range(1, len(t.form)) if not labels[i] and not labels[i - 1] and (japanese or t.begin[i] > t.end[i - 1])]
    if not places:
        return None
    # Often right after the first word of a sentence.
    heads = [i for i in places if t.cls[i - 1] == "cap" and (i < 2 or t.cls[i - 2] in (".", "nl", "!", "?"))]
    i = rng.choice(heads if heads and rng.random() < 0.25 else places)
    first, last = i, i
    while first and i - first < 8 and not labels[first - 1] and t.cls[first - 1] != "nl":
        first -= 1
    while last < len(t.form) and last - i < 8 and not labels[last] and t.cls[last] != "nl":
        last += 1
    head, tail = text[t.begin[first] : t.end[i - 1]], text[t.begin[i] : t.end[last - 1]] if last > i else ""
    gap = "" if japanese else " "
    spans: list[tuple[int, int, int]] = []
    if rng.random() < 0.3:  # another one before it, with some words between
        other = rng.choice([NAME, ADDRESS, PHONE])
        own = inventor.mention(other, japanese)
        if other != PHONE or own[0] in "+(0":
            begin = len(head) + len(gap)
            spans.append((other, begin, begin + len(own)))
            k = rng.choice(places)
            words = text[t.begin[k] : t.end[min(k + rng.randint(0, 2), len(t.form) - 1)]] if not any(labels[k : k + 3]) else ""
            head += gap + own + rng.choice(["、", "へ", "は"] if japanese else [",", ";", "", "."]) + (gap + words if words else "")
    kind = NAME if named else rng.choice([NAME, NAME, ADDRESS, ADDRESS, PHONE, IDNUM, IDNUM, O])
    lead = after = ""
    if kind == NAME:
        titled = not japanese and rng.random() < 0.3
        lead = rng.choice(["Herr ", "Frau ", "Dr. ", "Mr. ", "Mrs ", "Ms. ", "Mme ", "Sr. ", "Sra. ", "Sig. ", "Dott. ", "Dhr. ", "Mevr. ", "Prof. "]) if titled else ""
        own, after = inventor.name(japanese, alone=titled, titled=titled), rng.choice(["さん", "様", "氏", "先生", ""]) if japanese else ""
    elif kind == O:
        lead, own = inventor.cue("R", japanese), inventor.pattern(_OTHER)
    else:
        lead = inventor.cue("I", japanese) if kind == IDNUM else inventor.cue("P", japanese) if kind == PHONE and rng.random() < 0.7 else ""
        own = inventor.mention(kind, japanese)
        if kind == PHONE and not lead and own[0] not in "+(0":
            own = "+" + own
    begin = len(head) + len(gap) + len(lead)
    gap2 = "" if japanese or tail[:1] in (".", ",", ";", ":", ")", "") else " "
    if rng.random() < 0.4:
        tail, gap2 = "", rng.choice([".", ".", ",", "\n"])
    return head + gap + lead + own + after + gap2 + tail, spans + ([(kind, begin, begin + len(own))] if kind else [])


def spanned(t: Tokens, spans: list[tuple[int, int, int]]) -> list[int]:
    out = [O] * len(t.form)
    for y, b, e in spans:
        for i in range(bisect_left(t.begin, b), len(out)):
            if t.begin[i] >= e:
                break
            out[i] = y
    return out


def unknown(t: Tokens, labels: list[int], inventor: Inventor, share: float = 0.12) -> None:
    """Some ordinary words become unknown ones of the same ending."""
    for i, cls in enumerate(t.cls):
        if not labels[i] and cls in ("low", "cap") and t.tag[i] == "-" and t.mark[i] == "-" and inventor.rng.random() < share:
            t.form[i], t.rare[i], t.key[i] = inventor.rng.choice(_SYLLABLES) + t.form[i][2:], "0", None


def counted(sample: list[str]) -> dict[str, int]:
    """In how many of the texts a word, or a pair of kanji, is."""
    out: Counter[str] = Counter()
    for text in sample:
        out.update({w.casefold() for w in re.findall(r"[A-Za-zÀ-ɏ]+", text)} | {a + b for run in re.findall("[一-鿿々ヶ]{2,}", text) for a, b in zip(run, run[1:], strict=False)})
    return dict(out)


def examples(sample: list[str], names: Directory) -> Iterator[tuple[Tokens, Tokens, list[int]]]:
    """(tokens as they are, tokens as the features see them, labels) of the sample and of what is made of it."""
    nobody = Directory([])
    nobody.vocabulary = names.vocabulary
    inventor = Inventor(11, "".join(x for text in sample for x in re.findall("[一-鿿]+", text)))
    for k, text in enumerate(sample):
        full = Tokens(text, names)
        if not full.form:
            continue
        labels = weak_labels(text, full)
        yield full, Tokens(text, nobody) if k % 4 == 0 else full, labels
        spans = mentions(text, full, np.array(labels))
        if spans and k % 2 == 0:
            text2, spans2 = replaced(text, spans, inventor)
            t = Tokens(text2, nobody if k % 4 else names)
            own = spanned(t, spans2)
            unknown(t, own, inventor)
            yield t, t, own
        for made in filter(None, (inserted(text, full, labels, inventor, n % 2 == 1) for n in range(2 if k % 4 else 1))):
            t = Tokens(made[0], nobody)
            own = spanned(t, made[1])
            unknown(t, own, inventor, 0.5)
            yield t, t, own
        # Names are also written in lower case.
        if k % 3 == 0 and (low := _lowered(text, names)) != text:
            t = Tokens(low, names)
            yield t, t, weak_labels(low, t)


def fit(sample: list[str], names: Directory, epochs: int = EPOCHS) -> Model:
    """Maximum likelihood by AdaGrad over small batches; skip weight from how often joined tokens agree."""
    names.vocabulary = counted(sample)
    names.cells.clear()
    data, index = [], {}
    known: dict[tuple, list[int]] = {}
    same = differ = 0
    for full, t, labels in examples(sample, names):
        edge = ("^", "^", "-")
        cells = [edge] * 3 + list(zip(t.form, t.cls, t.mark, strict=True)) + [edge] * 3
        at, row = [], []
        for i, context in enumerate(t.contexts()):
            begin = len(at)
            cell = cells[i + 3]
            if (own := known.get(cell)) is None:
                own = known[cell] = [index.setdefault(f, len(index)) for f in own_features(*cell)]
            at += own
            for o in OFFSETS:
                key = (o, cell[1], *cells[i + 3 + o])
                if (own := known.get(key)) is None:
                    own = known[key] = [index.setdefault(f, len(index)) for f in near_features(*key)]
                at += own
            if (own := known.get(context)) is None:
                own = known[context] = [index.setdefault(f, len(index)) for f in context_features(*context)]
            at += own
            row += [i] * (len(at) - begin)
        data.append((np.array(at, np.int32), np.array(row, np.int32), np.array(labels)))
        seen: dict[str, int] = {}
        for i, key in enumerate(full.key):
            if key is not None:
                if key in seen and (labels[seen[key]] or labels[i]):
                    same, differ = same + (labels[seen[key]] == labels[i]), differ + (labels[seen[key]] != labels[i])
                seen[key] = i
    labels = len(LABELS)
    w, g2 = np.zeros((max(1, len(index)), labels), np.float32), np.full((max(1, len(index)), labels), 1e-6, np.float32)
    trans, tg2 = np.zeros((labels, labels)), np.full((labels, labels), 1e-6)
    data.sort(key=lambda d: len(d[2]))
    known.clear()
    batches = []
    while data:  # from the longest, each given up as it is taken
        batches.append(_batch(data[-40:]))
        del data[-40:]
    rng = np.random.default_rng(7)
    for epoch in range(epochs):
        rate = 0.3 / (1 + 0.3 * epoch)
        for bi in rng.permutation(len(batches)):
            size, used, inverse, firsts, token, order, heads, y, turns = batches[bi]
            live = np.arange(int(size.max()))[None, :] < size[:, None]
            unary = np.zeros((*live.shape, labels), np.float32)
            unary[live] = np.add.reduceat(w[used][inverse], firsts)
            p, pair = _expected(unary, trans, size)
            delta = -p[live].astype(np.float32)
            delta[np.arange(len(y)), y] += 1
            grad = np.add.reduceat(delta[token[order]], heads) - 2e-3 * w[used]
            g2[used] += grad**2
            w[used] += rate * grad / np.sqrt(g2[used])
            grad_t = turns - pair
            tg2 += grad_t**2
            trans += rate * grad_t / np.sqrt(tg2)
    # Two unknown capitalised words in a row are names more often than in the sample, whose words are all known.
    for name, k in index.items():
        if name.startswith(("rr=00|cap|cap", "rs=00|cap|cap")):
            w[k, NAME] += UNKNOWN_PAIR
    skip = float(np.clip(np.log((same + 1) * (labels - 1) / (differ + 1)), 0.0, 3.0))
    return Model(index, w, trans.astype(np.float32), skip)


def _batch(batch: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Of a batch: lengths; features in use; of each entry its feature; the first entry of each token; of each entry its
    token; entries in order of features and the first of each; labels; counts of turns from label to label."""
    size = np.array([len(y) for *_, y in batch])
    ahead = np.concatenate(([0], np.cumsum(size)[:-1]))
    token = np.concatenate([row + a for (_, row, _), a in zip(batch, ahead, strict=True)]).astype(np.int32)
    used, inverse = np.unique(np.concatenate([at for at, *_ in batch]), return_inverse=True)
    inverse = inverse.astype(np.int32)
    order = np.argsort(inverse, kind="stable").astype(np.int32)
    turns = np.zeros((len(LABELS), len(LABELS)))
    for *_, y in batch:
        np.add.at(turns, (y[:-1], y[1:]), 1)
    first = lambda ids: np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    return size, used, inverse, first(token), token, order, first(inverse[order]), np.concatenate([y for *_, y in batch]), turns


def _expected(unary: np.ndarray, trans: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals and expected transition counts of a batch."""
    b, n, labels = unary.shape
    peak = np.exp(unary.astype(np.float64) - unary.max(2, keepdims=True))
    step = np.exp(trans)
    live = np.arange(n)[None, :] < size[:, None]
    alpha, beta = np.empty((b, n, labels)), np.ones((b, n, labels))
    alpha[:, 0] = peak[:, 0] / peak[:, 0].sum(1, keepdims=True)
    for i in range(1, n):
        a = (alpha[:, i - 1] @ step) * peak[:, i]
        alpha[:, i] = a / a.sum(1, keepdims=True)
    for i in range(n - 2, -1, -1):
        x = (beta[:, i + 1] * peak[:, i + 1]) @ step.T
        x /= x.sum(1, keepdims=True)
        beta[:, i] = np.where(live[:, i + 1, None], x, 1.0 / labels)
    p = alpha * beta
    p /= p.sum(2, keepdims=True)
    q = alpha[:, :-1, :, None] * step * (peak * beta)[:, 1:, None, :]
    q /= np.maximum(q.sum((2, 3), keepdims=True), 1e-300)
    pair = q[live[:, 1:]].sum(0)
    p[~live] = 0
    return p, pair


def mentions(text: str, t: Tokens, labels: np.ndarray) -> list[tuple[int, int, int]]:
    """(label, begin, end) of the mentions, with the checks a written form allows."""
    out: list[list[int]] = []
    last = -2
    for i, y in enumerate(labels.tolist()):
        if y == O:
            continue
        cls = t.cls[i]
        if y == IDNUM and numeric(cls) and not (out and last == i - 1) and sum(map(str.isdigit, text[t.begin[i] : t.end[i]])) < 4 or y == EMAIL and cls != "mail" or y in (PHONE, IDNUM) and not (numeric(cls) or (out and out[-1][0] == y and last == i - 1 and cls in ("n", "init", "UP"))):
            continue
        if out and out[-1][0] == y and last == i - 1 and (y in (NAME, ADDRESS) or (y in (PHONE, IDNUM) and t.begin[i] - t.end[i - 1] < 2)):
            out[-1][2], out[-1][4] = t.end[i], i
        else:
            out.append([y, t.begin[i], t.end[i], i, i])
        last = i
    kept = []
    for y, _, _, i, j in out:
        if y == NAME:
            lettered = lambda k: t.cls[k] in ("cap", "UP", "low", "init", "han")
            while i <= j and (not lettered(i) or (t.form[i] in _TITLES and j > i and t.mark[i] == "-" and t.cls[i] != "init") or (t.form[i] == "m" and j > i + 1 and t.mark[i + 2] != "f")):
                i += 1
            while j >= i and not lettered(j):
                j -= 1
            if i <= j and all(t.cls[k] == "han" for k in range(i, j + 1)):
                # A lone kanji is a name before an honorific only; one left over before a name belongs to it.
                if i == j and t.mark[i] == "-" and not (j + 1 < len(t.form) and t.form[j + 1] in _HONORIFICS):
                    continue
                alone = i and t.cls[i - 1] == "han" and t.begin[i] == t.end[i - 1] and not (i > 1 and t.cls[i - 2] == "han" and t.begin[i - 1] == t.end[i - 2])
                if alone and t.mark[i] == "-" and t.mark[i - 1] == "-":
                    i -= 1
            if i > j or not any(t.cls[k] in ("cap", "UP", "han") or t.mark[k] != "-" for k in range(i, j + 1)):
                continue
        elif y == ADDRESS:
            while i <= j and t.cls[i] not in ("cap", "UP", "init", "han", "〒") and not t.cls[i].startswith("n") and not (t.cls[i] == "low" and i < j):
                i += 1
            if i >= j or not any(t.cls[k] == "n" or t.cls[k].startswith("n") for k in range(i, j + 1)):
                continue
        kept.append((y, t.begin[i], t.end[j]))
    return kept


def entries(people: DataFrame) -> DataFrame:
    """given, family: the distinct entries of a directory."""
    return people.select(F.col("given").cast("string").alias("given"), F.col("family").cast("string").alias("family")).distinct()


def texts(fields: DataFrame) -> DataFrame:
    return fields.where(F.col("name").isin(*ITEMS) & (F.length("value") > 0)).select(F.col("field_id").cast("long").alias("field_id"), F.col("value").cast("string").alias("text"))


def _words(text: Column) -> Column:
    """What a text may have in common with the directory: its words in lower case, and runs of two to five kanji."""
    runs = F.regexp_extract_all(text, F.lit("([一-鿿々ヶ]{2,})"), F.lit(1))
    pieces = F.flatten(F.transform(runs, lambda r: F.flatten(F.transform(F.sequence(F.lit(2), F.lit(5)), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(r) - n + 1, F.lit(1))), lambda k: F.substr(r, k, n))))))
    return F.array_distinct(F.concat(F.transform(F.regexp_extract_all(text, F.lit("([A-Za-zÀ-ɏ]+)"), F.lit(1)), F.lower), pieces))


def marked(own: DataFrame, people: DataFrame) -> tuple[DataFrame, set[str], set[str]]:
    """(texts with ``hits``, the entries of a large directory that each holds; beginnings and endings of family names).

    Words and entries meet by shuffle. Beginnings and endings are of three and four letters, so their number is bounded
    by the alphabet.
    """
    each = entries(people).select(F.explode(F.array(F.struct(F.lit("g").alias("kind"), F.col("given").alias("entry")), F.struct(F.lit("f").alias("kind"), F.col("family").alias("entry")))).alias("x")).select("x.*").where(F.length("entry") > 0).distinct()
    folded = each.withColumn("word", F.lower("entry"))
    # Texts are told apart by a number written with them: a row may be repeated and an id may be missing.
    long_ = folded.where((F.col("kind") == "f") & (F.length("word") >= 7) & (F.col("word") < "\u2e80"))
    ends = long_.select(F.substring("word", 1, 3).alias("h"), F.expr("right(word, 4)").alias("t"))
    heads, tails = ({r[0] for r in ends.select(c).distinct().collect()} for c in ("h", "t"))
    words = own.select("text").distinct().select("text", F.explode(_words(F.col("text"))).alias("word"))
    hits = words.join(folded, "word").groupBy("text").agg(F.collect_set(F.struct("kind", "entry")).alias("hits"))
    return own.join(hits, "text", "left").select("field_id", "text", "hits"), heads, tails


def train(fields: DataFrame, people: DataFrame, size: int = TRAIN_TEXTS, most: int = DIRECTORY_BYTES) -> tuple[Model, Directory | None]:
    """The field, fitted on an executor, and the directory if it can be broadcast."""
    spark = fields.sparkSession
    listed = entries(people)
    bytes_ = listed.agg(F.sum(F.coalesce(F.octet_length("given"), F.lit(0)) + F.coalesce(F.octet_length("family"), F.lit(0)) + 200)).first()[0] or 0
    few = bytes_ <= most
    own = texts(fields).select("text")
    # Half of the sample from texts with something that may be personal, half from all. A threshold on the hash, from
    # the number of items, bounds what is made distinct and ordered, so copies of one text can't fill the sample.
    n = fields.where(F.col("name").isin(*ITEMS)).count()
    likely = F.col("text").rlike(r"[@＠]|\d{5}|\(at\)|\[at\]|さん|様|氏|[Dd]r\.|Herr|Frau|M(?:r|rs|me)\b|Sra?\.|Sig|Dhr|Mevr")
    h = F.xxhash64("text")
    near = F.pmod(h, F.lit(1_000_000)) < min(1.0, SAMPLE_FACTOR * size / max(1, n)) * 1_000_000
    rows = own.where(near).select(h.alias("h"), "text", likely.alias("likely")).distinct()
    drawn = lambda df, n: df.orderBy("h", "text").limit(n)
    sample = drawn(rows.where("likely"), size // 2).union(drawn(rows, size - size // 2)).select("text").distinct()
    if few:
        names = Directory([(r[0], r[1]) for r in listed.collect()])
    else:
        sample, heads, tails = marked(sample.withColumn("field_id", F.lit(0).cast("long")), people)
        found_ = sample.select(F.explode("hits").alias("x")).select("x.*").distinct().collect()  # of a bounded sample
        names = Directory([(r["entry"], None) if r["kind"] == "g" else (None, r["entry"]) for r in found_])
        names.heads, names.tails = heads, tails
    shared = spark.sparkContext.broadcast(names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampled = sorted(x for pdf in batches for x in pdf["text"])
        own = shared.value
        yield pd.DataFrame({"model": [pickle.dumps((fit(sampled, own), own.vocabulary))]})

    made = sample.select("text").coalesce(1).mapInPandas(run, "model binary").collect()
    model, vocabulary = pickle.loads(made[0]["model"]) if made else (fit([], names), {})
    names.vocabulary = vocabulary
    return (model, names) if few else (model, _without(names))


def _without(names: Directory) -> Directory:
    """What holds for any text: no entries, but how family names begin and end, and the counted words."""
    out = Directory([])
    out.heads, out.tails, out.vocabulary, out.partial = names.heads, names.tails, names.vocabulary, True
    return out


def label(fields: DataFrame, people: DataFrame, trained: tuple[Model, Directory] | None = None, most: int = DIRECTORY_BYTES) -> DataFrame:
    """field_id, text, readable (placeholders in place), mentions (kind, start_pos, end_pos, from 1)."""
    model, names = trained or train(fields, people, most=most)
    shared = fields.sparkSession.sparkContext.broadcast((model, names))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, known = shared.value
        for pdf in batches:
            if known.partial:  # the entries that the texts of this batch hold
                hits = {(h["kind"], h["entry"]) for row in pdf["hits"] if row is not None for h in row}
                here = Directory([(e, None) if k == "g" else (None, e) for k, e in hits])
                here.heads, here.tails, here.vocabulary = known.heads, known.tails, known.vocabulary
            else:
                here = known
            distinct = list(dict.fromkeys(pdf["text"]))
            tokens = [Tokens(x, here) for x in distinct]
            found_ = {x: mentions(x, t, y) for x, t, y in zip(distinct, tokens, own.label(tokens), strict=True)}
            yield pd.DataFrame({"field_id": pdf["field_id"], "text": pdf["text"], "readable": [readable(x, found_[x]) for x in pdf["text"]], "mentions": [[{"kind": LABELS[y], "start_pos": b + 1, "end_pos": e} for y, b, e in found_[x]] for x in pdf["text"]]})

    every = marked(texts(fields), people)[0] if names.partial else texts(fields)
    return every.mapInPandas(run, "field_id long, text string, readable string, mentions array<struct<kind:string,start_pos:int,end_pos:int>>")


def readable(text: str, found_: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for y, b, e in sorted(found_, key=lambda m: m[1]):
        if b >= at:
            out += [text[at:b], PLACEHOLDER[y]]
            at = e
    return "".join([*out, text[at:]])


def redact(fields: DataFrame, people: DataFrame) -> DataFrame:
    """field_id and the readable text with typed placeholders."""
    return label(fields, people).select("field_id", "readable")


def report(fields: DataFrame, people: DataFrame) -> DataFrame:
    """Mentions and affected items per kind."""
    return label(fields, people).select("field_id", F.explode("mentions").alias("m")).groupBy(F.col("m.kind").alias("kind")).agg(F.count("*").alias("mentions"), F.countDistinct("field_id").alias("items"))


def found(fields: DataFrame, people: DataFrame) -> DataFrame:
    """field_id, kind, start_pos."""
    return label(fields, people).select("field_id", F.explode("mentions").alias("m")).select("field_id", "m.kind", "m.start_pos").distinct()
