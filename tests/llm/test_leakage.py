import random

from folioforge.llm import leakage as L

DOCS = "doc_id long, text string, item_id string"
ITEMS = "item_id long, suite string, lang string, text string"


def brute(docs, items, nw, nl):
    out = set()
    for d, text in docs:
        w = L.words(text or "")
        s = "".join(w)
        for i, lang, x in items:
            v = L.words(x or "")
            if lang == "ja":
                v = "".join(v)
                hit = any(v[k : k + nl] in s for k in range(len(v) - nl + 1))
            else:
                have = {tuple(w[k : k + nw]) for k in range(len(w) - nw + 1)}
                hit = any(tuple(v[k : k + nw]) in have for k in range(len(v) - nw + 1))
            if hit:
                out.add((d, i))
    return out


def frames(spark, docs, items):
    return spark.createDataFrame([(d, t, "x") for d, t in docs], DOCS), spark.createDataFrame([(i, "s", lang, t) for i, lang, t in items], ITEMS)


def test_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(6)]
    kana = "あいうえおかきくけこ"
    items = [(i, "en", " ".join(rng.choices(vocab, k=rng.randrange(3, 30)))) for i in range(30)] + [(100 + i, "ja", "".join(rng.choices(kana[:3], k=rng.randrange(5, 40)))) for i in range(10)] + [(200, "en", None), (201, "en", "")]
    docs = [(d, " ".join(rng.choices([*vocab, "zz"], k=rng.randrange(0, 120)))) for d in range(60)] + [(500 + d, "".join(rng.choices([*kana[:3], "z"], k=80))) for d in range(20)] + [(900, None), (901, "")]
    a, b = frames(spark, docs, items)
    for k in ({}, {"shard_tokens": 50}, {"block_tokens": 60}):
        got = L.leaks(a, b, min_words=6, min_letters=7, **k).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == brute(docs, items, 6, 7)
        assert len(got) == len({(r["doc_id"], r["item_id"]) for r in got})


def test_hot_passage(spark, monkeypatch):
    """A passage in every document and in many items: matched once, and the pairs come in small blocks."""
    common = " ".join(f"c{k}" for k in range(9))
    items = [(i, "en", f"x{i} {common} y{i} {common} c0") for i in range(20)]
    docs = [(d, f"z{d} {common} q {common} c0" if d % 3 else f"{common} x7 {common} y7") for d in range(200)]
    a, b = frames(spark, docs, items)
    want = {(r["doc_id"], r["item_id"], r["longest"], r["doc_place"], r["item_place"]) for r in L.leaks(a, b, min_words=6).collect()}
    assert {w[:2] for w in want} == {(d, i) for d in range(200) for i in range(20)}
    assert {w[2:] for w in want if w[0] % 3} == {(10, 11, 11)} and {w[2:] for w in want if not w[0] % 3 and w[1] != 7} == {(9, 0, 1)}
    assert {w[2:] for w in want if not w[0] % 3 and w[1] == 7} == {(11, 9, 0)}
    monkeypatch.setattr(L.Shard.matches, "__defaults__", (7,))
    items_, shard = L.Items([(i, L.words(t)) for i, _, t in items], 6), None
    shard = L.Shard(items_)
    for d, t in docs:
        shard.add(d, L.np.array([items_.ids.get(w, 0) for w in L.words(t)], L.np.int32))
    assert {tuple(r) for f in shard.matches() for r in f.itertuples(index=False)} == want


def test_alterations_and_places(spark):
    item = "The night shift of Quaethe exchanges a brass key for 54 blank index cards unless the inspector has already signed the margin."
    altered = item.upper().replace("BRASS", "<b>BR­A​SS</b>").replace(" ", " ").replace("INDEX", "**INDEX**\n> ")
    wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in item)
    ja = "瑠璃坂行きの渡し船が休みになる晩に、千草ヶ淵でいちばん若い司書は封をした封筒484通を分けます。"
    docs = [(1, "intro words " + altered + " tail"), (2, wide), (3, " ".join(item.split()[:11])), (4, "x " + ja[:20] + "\n" + ja[20:]), (5, item + " . " + item), (6, " ".join(item.split()[:12])), (7, None)]
    a, b = frames(spark, docs, [(1, "en", item), (2, "ja", ja), (3, "en", item)])
    got = {(r["doc_id"], r["item_id"]): r for r in L.leaks(a, b).collect()}
    assert set(got) == {(d, i) for d in (1, 2, 5, 6) for i in (1, 3)} | {(4, 2)}
    assert got[1, 1]["longest"] == len(L.words(item)) and got[1, 1]["doc_place"] == 2 and got[1, 1]["item_place"] == 0
    assert got[6, 1]["longest"] == 12
    assert {r["doc_id"] for r in L.remove(a, b).collect()} == {3, 7}
    rep = {r["item_id"]: r["n_docs"] for r in L.report(a, b).collect()}
    assert rep == {1: 4, 2: 1, 3: 4}


def test_long_and_empty(spark):
    text = " ".join(f"a{k % 7}" for k in range(60_000))
    a, b = frames(spark, [(1, text)], [(1, "en", " ".join(f"a{k % 7}" for k in range(40)))])
    assert [(r["doc_id"], r["longest"]) for r in L.leaks(a, b).collect()] == [(1, 40)]
    assert L.found(a.limit(0), b).count() == 0 and L.found(a, b.limit(0)).count() == 0
