import random

import pytest
from pyspark.sql import functions as F

from folioforge.llm import langid as L

DOCS = "doc_id long, text string, lang string, code string"
EN = ["The view index was closed before the office opened again.", "There were no questions about this point.", "The mail archive needs to be rebuilt before the next meeting.", "We counted {n} documents and compared them with the list."]
DE = ["Der Ansichtsindex wurde vor der Öffnung des Büros geschlossen.", "Zu diesem Punkt gab es keine weiteren Rückfragen.", "Das Mailarchiv muss vor der nächsten Sitzung neu aufgebaut werden.", "Wir haben {n} Dokumente gezählt und mit der Liste verglichen."]
FR = ["L'index de la vue a été fermé avant l'ouverture du bureau.", "Ce point n'a soulevé aucune question dans la salle.", "L'archive du courrier doit être reconstruite avant la réunion.", "Nous avons compté {n} documents et les avons comparés à la liste."]
JA = ["ビューの索引は事務所が開く前に閉じられました。", "この点について質問はありませんでした。", "メールの保管庫は次の会議までに作り直す必要があります。", "文書を{n}件数え、一覧と照らし合わせました。"]
ALL = {"en": EN, "de": DE, "fr": FR, "ja": JA}


def corpus(n=160, wrong=0.1):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = sorted(ALL)[i % 4]
        text = ("" if lang == "ja" else " ").join(rng.choice(ALL[lang]).format(n=rng.randrange(999)) for _ in range(4))
        label = rng.choice([x for x in ALL if x != lang]) if rng.random() < wrong else {"en": " EN_us", "de": "Deutsch", "fr": "fra", "ja": "日本語"}[lang] if i % 5 == 0 else lang
        rows.append((i, text, label, lang))
    return rows


@pytest.fixture(scope="module")
def trained(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS)
    return rows, df, L.train(df)


def test_held_out_accuracy(spark, trained):
    rows, df, models = trained
    held = {"en": "The quarterly report was restored from the copy and the owner has been informed.", "de": "Die Buchhaltung ist für externe Leser noch nicht verfügbar, weil niemand die Liste gepflegt hatte.", "fr": "La comptabilité n'est pas encore accessible aux lecteurs parce que personne n'avait mis à jour la liste.", "ja": "経理の窓口はまだ社外の方には公開していません。"}
    for lang, text in held.items():
        assert models.languages[models.entropies([L.plain(text)])[0].argmin()] == lang
    got = {r["doc_id"]: r["main"] for r in L.segments(df, models).collect()}
    assert sum(got[i] == code for i, _, _, code in rows) >= 0.99 * len(rows)


def test_cases(spark, trained):
    _, _, models = trained
    mixed = EN[0] + " " + EN[1] + "\n\n" + JA[0] + JA[1] + "\n\n2024-01-18T07:01:13Z INFO unid=64511ECE97FB97D1\n| Hafenport | 1 | 2 |\n-- \nVelmar / Minutes EN 26 / vault\\x\\11.nsf"
    docs = [(1, EN[0] + " " + EN[2], "en", ""), (2, EN[0] + " " + EN[2], "de", ""), (3, DE[0], None, ""), (4, DE[0], "und", ""), (5, mixed, "en", ""), (6, None, None, ""), (7, "", "xx", ""), (8, FR[0] + " " + FR[2], "fr-CA", ""), (9, "> " + DE[2][:30] + "\n> " + DE[2][30:], "de-AT", ""), (2, EN[0] + " " + EN[2], "de", "")]
    every = L.segments(spark.createDataFrame(docs, DOCS), models)
    rows = [(r["doc_id"], r["label"], r["main"], r["langs"]) for r in every.collect()]
    by = {r[0]: r[1:] for r in rows}
    assert by[1] == ("en", "en", ["en"]) and by[2] == ("de", "en", ["en"]) and by[3] == (None, "de", ["de"]) and by[4] == (None, "de", ["de"])
    assert by[5] == ("en", "en", ["en", "ja"]) and by[6] == (None, None, []) and by[7] == (None, None, []) and by[8] == ("fr", "fr", ["fr"]) and by[9] == ("de", "de", ["de"])
    assert sum(r[0] == 2 for r in rows) == 2
    seg = {(r["lang"], r["begin"]) for r in L.label(spark.createDataFrame(docs, DOCS), models).where("doc_id = 5").collect()}
    assert seg == {("en", 1), ("ja", mixed.index(JA[0]) + 1)}


def test_found_and_empty(spark, trained):
    rows, df, _ = trained
    got = {r["doc_id"] for r in L.found(df).collect()}
    wrong = {i for i, _, label, code in rows if label in ALL and label != code}
    assert wrong <= got and len(got - wrong) <= 1
    assert L.found(df.limit(0)).count() == 0
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r["main"] for r in L.segments(unlabelled, L.train(unlabelled)).collect()} == {None} and L.found(unlabelled).count() == 0


def test_kneser_ney_sums_to_one(trained):
    """Over the alphabet, the probabilities after any context sum to about one."""
    _, _, models = trained
    import numpy as np

    chars = sorted({c for t in EN for c in L.plain(t)})
    j = models.languages.index("en")
    context = "the "
    base = models.entropies([context])[0, j] * len(context)
    total = sum(np.exp(-(models.entropies([context + c])[0, j] * (len(context) + 1) - base)) for c in chars)
    assert 0.7 < total <= 1.001


def test_labels():
    assert len(L.CODES.split()) == len(set(L.CODES.split())) and "xx" not in L.CODES.split()


def test_labels_of_any_language(spark):
    """Swedish isn't among the named ones; a code that only wrong labels bear makes no language."""
    sv = ["Index för vyn stängdes innan kontoret öppnade igen.", "Det fanns inga frågor om den här punkten.", "E-postarkivet måste byggas om före nästa möte.", "Vi räknade {n} dokument och jämförde dem med listan."]
    rng = random.Random(2)
    more = [(1000 + i, " ".join(rng.choice(sv).format(n=rng.randrange(999)) for _ in range(4)), "sv-SE" if i % 2 else "sv", "sv") for i in range(60)]
    wrong = [(2000 + i, " ".join(rng.sample(EN, 2)).format(n=i), "pl", "en") for i in range(8)]
    # Enough different sentences of certain label, so that a language needs some.
    many = [(3000 + 10 * i + k, f"{s} Entry {'abcdefghijklmnopqrstuvwxyz'[i]} of the list was checked again.".format(n=i), "en", "en") for i in range(26) for k, s in enumerate(EN * 2)]
    many += [(6000 + 10 * i + k, f"{s} Punkt {'abcdefghijklmnopqrstuvwxyz'[i]} in der Liste wurde noch einmal geprüft.".format(n=i), "de", "de") for i in range(26) for k, s in enumerate(DE * 2)]
    many += [(9000 + 10 * i + k, f"{s} Punkten {'abcdefghijklmnopqrstuvwxyz'[i]} på listan kontrollerades igen.".format(n=i), "sv", "sv") for i in range(26) for k, s in enumerate(sv * 2)]
    df = spark.createDataFrame(more + wrong + many, DOCS)
    models = L.train(df)
    assert models.languages == ["de", "en", "sv"]
    got = {r["doc_id"]: (r["label"], r["main"]) for r in L.segments(df, models).collect()}
    assert all(got[i] == ("sv", "sv") for i, *_ in more) and all(got[i] == ("pl", "en") for i, *_ in wrong)


def test_sample_is_bounded(spark):
    df = spark.createDataFrame(corpus(400, 0.0) + [(None, EN[0], "en", "en")], DOCS)
    drawn = {r["code"]: r["count"] for r in L._sampled(df, 30).groupBy("code").count().collect()}
    assert all(10 <= n <= 60 for n in drawn.values()) and set(drawn) == set(ALL)
    assert L.train(df, per_label=30).languages == sorted(ALL)


def test_confidence_is_calibrated(spark, trained):
    """On held-out sentences the mean confidence is near the share that is right, and never certain."""
    rows, _, models = trained
    held = [(code, t) for i, (_, text, _, code) in enumerate(corpus(80, 0.0)) for t in [text] if i % 2]
    got = models.judge([L.plain(t) for _, t in held])
    right = sum(lang == code for (code, _), (lang, _) in zip(held, got, strict=True)) / len(held)
    mean = sum(x for _, x in got) / len(got)
    assert abs(mean - right) < 0.1 and all(x < 1 for _, x in got)
