import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm import garbled as G

FIELDS = "field_id long, value string, value_list array<string>, text string"
ATTS = "att_id long, name string, saved_name string"
CORPUS = [
    "Die Überschriften müssen größer und die Fußnoten kürzer werden. Störung: “Anlage” fehlt.", "Café closed: “summer hours”. L'état de l'accès à l'archive n'était pas prêt.",
    "出張承認の申請：添付ファイルの欠落。保管庫の利用申請、よくある質問、議事録。", "Situação da exportação: índice e réplica não disponíveis.",
]


def run(spark, fields, atts=()):
    f, a = spark.createDataFrame(fields, FIELDS), spark.createDataFrame(list(atts), ATTS)
    corpus = spark.createDataFrame([(t,) for t in CORPUS * 2], "text string")
    return f, a, G.texts(f, a), corpus


def test_chains_found_and_restored(spark):
    clean = ["Die Überschriften müssen größer werden", "Café closed: “summer hours”", "出張承認の申請", "添付ファイルの欠落", "Situação da exportação", "Störung: Anlage fehlt"]
    fields, want, sure = [], {}, set()
    i = 0
    for text in clean:
        for name in ("utf-8>cp1252", "utf-8>latin-1", "utf-8>cp437", "utf-8>mac_roman", "utf-8>cp1251", "utf-8>cp932", "utf-8>cp1252 utf-8>cp1252", "cp1252>cp437", "cp1252>utf-8", "cp932>cp1252", "cp932>utf-8", "euc_jp>cp932"):
            bad = G.garble(text, G.CHAIN_OF[name])
            if bad is None or bad == text:
                continue
            i += 1
            fields.append((i, bad, None, None) if i % 2 else (i, None, ["x", None, bad], None))
            want[i] = text
            if name in ("utf-8>cp1252", "utf-8>latin-1", "utf-8>cp437", "utf-8>mac_roman", "utf-8>cp1251", "cp932>cp1252", "utf-8>cp1252 utf-8>cp1252"):
                sure.add(i)
    _, _, ex, corpus = run(spark, fields)
    rows = {r["row_id"]: r for r in G.restore(ex, corpus).collect()}
    assert set(rows) == set(want)
    assert {i: rows[i]["mended"] for i in sure} == {i: want[i] for i in sure}
    assert all(rows[i]["mended"] == want[i] for i in rows if rows[i]["restored"])


def test_decoys_and_odd_rows(spark):
    fields = [
        (1, "Folder tree: vault ├─ in └─ out", None, None), (2, "Column Σ shows 73 µs, n.º 5, Sr.ª A", None, None), (3, "The label reads “Архив 8”.", None, None), (4, "型番はｱｰｶｲﾌﾞ-6号です。", ["ｶﾀﾛｸﾞ"], None),
        (5, "Łucja Íñigo Zoë", None, None), (6, None, None, None), (7, "", [], None), (8, "plain ascii", [None], None), (9, "ATENÇÃO: A DOCUMENTAÇÃO", None, None), (10, "Caf� closed", None, None), (10, "Caf� closed", None, None),
        (11, "x" * 200_000 + " Ã¼ber größer StÃ¶rung", None, None),
    ]
    f, a, ex, corpus = run(spark, fields, [(1, "résumé.pdf", "rÃ©sumÃ©.pdf"), (2, "ｶﾀﾛｸﾞ.zip", None), (3, None, None), (4, "├─.txt", "Störung.txt")])
    got = {tuple(r) for r in G.affected(ex, corpus).select("src_table", "row_id").distinct().collect()}
    assert got == {("doc_fields", 10), ("doc_fields", 11), ("doc_attachments", 1)}


def test_empty(spark):
    _, _, ex, corpus = run(spark, [])
    assert G.affected(ex, corpus).count() == 0
    assert G.affected(ex, corpus.limit(0)).count() == 0


def test_shuffle_path_agrees(spark, monkeypatch):
    fields = [(i, t, None, None) for i, t in enumerate(["StÃ¶rung: Anlage fehlt", "Caf� closed", "Störung", "å‡ºå¼µæ‰¿èª\x8d"])]
    _, _, ex, corpus = run(spark, fields)
    want = {r["row_id"] for r in G.affected(ex, corpus).collect()}
    monkeypatch.setattr(G, "BROADCAST_BYTES", 0)
    assert {r["row_id"] for r in G.affected(ex, corpus).collect()} == want == {0, 1, 3}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcäöüßéèàçñ “”–€", min_size=1, max_size=12), st.sampled_from([n for n in G.CHAIN_OF if n.startswith("utf-8>") and not any(m in n for m in ("cp932", "euc", "gbk", "big5"))]))
def test_exact_round_trip(word, name):
    chain = G.CHAIN_OF[name]
    bad = G.garble(word, chain)
    if bad is not None and bad != word:
        assert G.ungarble(bad, chain) == word


def test_no_length_is_left_out(spark):
    """Japanese of any length goes by windows; everything else of any length is looked up, whole and by pieces."""
    assert max(map(len, G.tokens("添付" * 10_000 + "\x81", G.odd_pattern(set())))) <= G.LONGEST
    long = "Grundstücksverkehrsgenehmigungszuständigkeitsübertragungsverordnung"
    joined = "Größe\u00a0" * 60 + "über"
    cyrillic = "Превысокомногорассмотрительствующий"
    clean = [long, joined, cyrillic, "ô" * 13, f"出張承認の申請{long}出張承認の申請出張承認"]
    chains = ["cp1252>mac_roman", "cp1252>cp850", "utf-8>cp1252 utf-8>cp1252", "utf-8>cp437", "utf-8>cp932", "utf-8>cp1252 utf-8>cp1252 utf-8>cp1252"]
    bad = [b for t in clean for c in chains if (b := G.garble(t, G.CHAIN_OF[c])) and b != t] + [G.garble(long, G.CHAIN_OF["cp1252>mac_roman"]) + "添付ファイル" * 30]
    fields = [(i, b, None, None) for i, b in enumerate(bad)] + [(1000 + i, t, None, None) for i, t in enumerate(clean)]
    _, _, ex, corpus = run(spark, fields)
    own = spark.createDataFrame([(" ".join(clean),)] * 2, "text string")
    assert {r["row_id"] for r in G.affected(ex, corpus.union(own)).collect()} == set(range(len(bad)))


def test_share_restored(spark):
    """Of texts garbled without loss under every chain at least 95 in 100 come back as they were, the rest unmarked."""
    rows = [(t, c, b) for t in CORPUS for c, chain in G.CHAIN_OF.items() if (b := G.garble(t, chain)) and b != t and G.ungarble(b, chain) == t]
    _, _, ex, corpus = run(spark, [(i, b, None, None) for i, (*_, b) in enumerate(rows)])
    got = {r["row_id"]: r for r in G.restore(ex, corpus).collect()}
    good = sum(i in got and got[i]["mended"] == t for i, (t, *_) in enumerate(rows))
    assert len(rows) > 60 and good / len(rows) >= 0.95, [(c, got[i]["mended"] if i in got else None) for i, (t, c, _) in enumerate(rows) if i not in got or got[i]["mended"] != t]
    assert all(got[i]["mended"] == t for i, (t, *_) in enumerate(rows) if i in got and got[i]["restored"])


def test_bytes_without_a_character():
    with pytest.raises(UnicodeError):
        G.encode("語", "cp1252")


def test_the_frequent_form_is_the_clean_one(spark):
    """Half-width kana read as another Japanese encoding give kanji; kanji give half-width kana the same way back."""
    name = "ｶﾀﾛｸﾞ"
    bad = G.garble(name, G.CHAIN_OF["euc_jp>cp932"])
    assert G.garble(bad, G.CHAIN_OF["cp932>euc_jp"]) == name
    fields = [(i, None, None, None) for i in range(2)]
    atts = [(i, f"{name}.zip", None) for i in range(60)] + [(100, f"{bad}.zip", None), (101, G.garble(name, G.CHAIN_OF["cp932>cp1252"]) + ".zip", None), (102, G.garble(name, G.CHAIN_OF["utf-8>cp1252"]) + ".zip", None)]
    _, _, ex, corpus = run(spark, fields, atts)
    got = {r["row_id"] for r in G.affected(ex, corpus).collect()}
    assert got & set(range(60)) == set() and {101, 102} <= got


def test_copies_of_a_garbled_text_stay(spark, monkeypatch):
    """However many copies there are; a form is only taken for the clean one if it may be, and by distinct texts."""
    single, utf8 = G.garble("Störung", G.CHAIN_OF["cp1252>cp850"]), G.garble("déc", G.CHAIN_OF["utf-8>cp1252"])
    fields = [(i, f"{single}: Anlage fehlt", None, None) for i in range(100)] + [(i, utf8, None, None) for i in range(100, 200)] + [(200, "déc", None, None)]
    word = "添付"
    kana = G.garble(word, G.CHAIN_OF["euc_jp>cp932"])
    atts = [(i, f"{kana}.zip", None) for i in range(200)] + [(i, f"{word} {i}.zip", None) for i in range(300, 310)] + [(i, f"ｶﾀﾛｸﾞ {i}.zip", None) for i in range(400, 410)]
    assert G.contested(kana, "euc_jp>cp932", set())
    _, _, ex, corpus = run(spark, fields, atts)
    got = {(r["src_table"], r["row_id"]) for r in G.affected(ex, corpus).collect()}
    assert got == {("doc_fields", i) for i in range(200)} | {("doc_attachments", i) for i in range(200)}
    monkeypatch.setattr(G, "BROADCAST_BYTES", 0)
    assert {(r["src_table"], r["row_id"]) for r in G.affected(ex, corpus).collect()} == got


def test_single_letters_in_multibyte_decodings(spark):
    """Kanji of the first level or half-width kana amid ASCII letters are the only sign."""
    bad = [(w, d, G.garble(w, G.CHAIN_OF[f"utf-8>{d}"])) for d in ("gbk", "euc_jp", "big5", "cp932") for w in ("Müller", "café", "Störung", "für", "não")]
    assert {"M眉ller", "caf茅", "M端ller", "St旦rung", "fﾃｼr"} <= {b for _, _, b in bad}
    clean = spark.createDataFrame([(f"Müller café Störung für não {c}",) for c in ("ﾃ ｼ ｶ", "ﾃｼ ﾃ", "ｼ")], "text string")
    fields = [(i, b, None, None) for i, (_, _, b) in enumerate(bad)] + [(100, "Müller: Störung", None, None), (101, "出張承認の申請", None, None), (102, "ﾃｼﾌﾞﾙ", None, None)]
    _, _, ex, corpus = run(spark, fields)
    got = {r["row_id"]: (r["mended"], r["restored"]) for r in G.restore(ex, corpus.union(clean)).collect()}
    assert set(got) == set(range(len(bad)))
    by = {b: got[i] for i, (_, _, b) in enumerate(bad)}
    assert by["M眉ller"] == by["M端ller"] == ("Müller", True) and by["caf茅"] == ("café", True) and by["fﾃｼr"] == ("für", True)


def test_multibyte_decodings_of_utf8_show():
    """A lead and a continuation byte give a wide character or a replacement: what tokens() relies on."""
    for name in G._MULTI:
        for lead in range(0xC2, 0xF5):
            for follow in range(0x80, 0xC0):
                text = bytes([lead, follow]).decode(name, "replace")
                assert "�" in text or G._WIDE.search(text), (name, lead, follow)
    bad = G.garble("Ǳx", G.CHAIN_OF["utf-8>big5"])
    assert bad == "Дx" and bad in G.tokens(f"a {bad}", G.odd_pattern({*bad}))


def test_long_words_by_pieces(spark):
    word = "Überschriftengrößenänderungsverfahrensordnungsprüfungsausschüsse"
    joined = "Die\u00a0Überschriften\u00a0müssen\u00a0größer\u00a0und\u00a0kürzer\u00a0werden"
    chains = ["cp1252>cp850", "cp1252>mac_roman", "cp1252>cp437", "mac_roman>cp1252", "utf-8>cp437", "cp1252>utf-8", "cp1252>cp932"]
    bad = [(t, G.garble(t, G.CHAIN_OF[c])) for t in (word, joined) for c in chains]
    bad += [(word, "x" + G.garble(word, G.CHAIN_OF["cp1252>cp850"])), (word * 3, G.garble(word * 3, G.CHAIN_OF["cp1252>mac_roman"]))]
    fields = [(i, b, None, None) for i, (_, b) in enumerate(bad)] + [(100, word, None, None), (101, joined, None, None), (102, "x" * 60 + "é", None, None)]
    _, _, ex, corpus = run(spark, fields)
    own = spark.createDataFrame([(f"{word} {joined}",)] * 2, "text string")
    got = {r["row_id"]: r for r in G.restore(ex, corpus.union(own)).collect()}
    assert set(got) == set(range(len(bad)))
    assert all(got[i]["mended"] == bad[i][0] for i in (0, 1))


def test_seven_bit_encodings(spark):
    """ISO-2022-JP without its escape characters, whole, mixed with digits and cut off; UTF-7; and texts that look alike."""
    text = "出張承認の申請：添付ファイルの欠落。"
    jis = G.garble(text, G.CHAIN_OF["iso2022_jp>escapes lost"])
    assert jis.startswith("$B") and jis.endswith("(B") and jis.isascii()
    mixed = G.garble("5月15日", G.CHAIN_OF["iso2022_jp>escapes lost"])
    fields = [(1, jis, None, None), (2, f"See {jis} and more", None, None), (3, None, [mixed], None), (4, jis[:-7], None, None), (5, "Die +ANw-berschriften m+APw-ssen", None, None)]
    fields += [(10, "US$BN 30 (B)", None, None), (11, "+49-30-5550147 +abc-", None, None), (12, "cost $Bxyz$ total", None, None)]
    _, _, ex, corpus = run(spark, fields)
    more = spark.createDataFrame([("5月15日",)] * 2, "text string")
    got = {r["row_id"]: (r["mended"], r["restored"]) for r in G.restore(ex, corpus.union(more)).collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    assert got[1] == (text, True) and got[2] == (f"See {text} and more", True) and got[3] == ("5月15日", True)
    assert got[4][0].startswith("出張承認の申請：添付ファイル") and got[5] == ("Die Überschriften müssen", True)


def test_line_drawings(spark):
    bad = G.garble("├─ in └─ out", G.CHAIN_OF["utf-8>cp1252"])
    _, _, ex, corpus = run(spark, [(1, bad, None, None), (2, "vault ├─ in └─ out", None, None), (3, G.garble("für", G.CHAIN_OF["utf-8>cp437"]), None, None)])
    corpus = corpus.union(spark.createDataFrame([("für",)] * 2, "text string"))
    got = {r["row_id"]: r["mended"] for r in G.restore(ex, corpus).collect()}
    assert got == {1: "├─ in └─ out", 3: "für"}
