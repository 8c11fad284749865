import random
import unicodedata

from kinesift.llm import confusables, leaks


def test_looks_the_same():
    same = [
        ("Full width", "Ｆｕｌｌ ｗｉｄｔｈ"),
        ("sans style", "𝗌𝖺𝗇𝗌 𝗌𝗍𝗒𝗅𝖾"),
        ("naïve café", unicodedata.normalize("NFD", "naïve café")),
        ("office fluff", "oﬃce ﬂuﬀ"),
        ("zero width", "ze​ro⁠ wi­dth﻿"),
        ("a b c", "a b c"),
        ("half-finished", "half‑finished"),
        ("peace", "реасе"),
        ("HOPE", "ΗΟΡΕ"),
        ("ガラス", "ｶﾞﾗｽ"),
    ]
    for a, b in same:
        assert a != b and confusables.skeleton(a) == confusables.skeleton(b), (a, b)


def test_what_a_reader_tells_apart_stays_apart():
    for a, b in [("Case", "case"), ("cafe", "café"), ("l0", "lO"), ("1l", "Il"), ("x2", "x²"), ("strasse", "straße"), ("a.", "a!"), ("и", "й"), ("a-b", "a—b"), ("a b", "ab"), ("ring 1", "ring ①")]:
        assert confusables.skeleton(a) != confusables.skeleton(b), (a, b)


def test_skeleton_is_stable():
    rng = random.Random(1)
    for _ in range(300):
        t = "".join(chr(rng.choice([rng.randrange(32, 0x600), rng.randrange(0x1E00, 0x2100), rng.randrange(0x3040, 0x30FF), rng.randrange(0xFB00, 0xFB07), rng.randrange(0xFF01, 0xFF9F), rng.randrange(0x1D400, 0x1D7FF)])) for _ in range(40))
        s = confusables.skeleton(t)
        assert confusables.skeleton(s) == s
        assert confusables.skeleton(unicodedata.normalize("NFC", t)) == s == confusables.skeleton(unicodedata.normalize("NFD", t))


def test_twins_are_pairs_of_different_texts(spark):
    rows = [(1, "peace"), (2, "реасе"), (3, "peace"), (4, "p​eace"), (5, "Peace"), (6, None), (7, ""), (8, "​"), (None, "peace"), (1, "peace")]
    df = spark.createDataFrame(rows, "id bigint, t string").selectExpr("id", "t", "1 AS skeleton_hash", "2 AS t1")
    got = sorted(tuple(r) for r in confusables.twins(df, "id", "t").collect())
    assert got == [(1, 2), (1, 4), (2, 3), (2, 4), (3, 4), (7, 8)]
    c = {r.id: (r.class_id, r.n_forms) for r in confusables.canonical(df.filter("id IS NOT NULL"), "id", "t").collect()}
    assert c[4] == (1, 3) and c[5] == (5, 1) and 6 not in c
    assert confusables.twins(df.limit(0), "id", "t").count() == 0


WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ru", "te") for b in ("na", "so", "vi", "du", "pe") for c in ("r", "l", "n", "th", "ck")]


def made(seed):
    rng = random.Random(seed)
    items = [(100 + k, " ".join(rng.choice(WORDS) for _ in range(60)) + ".") for k in range(20)]
    return rng, items


def test_altered_passages_are_found_and_short_phrases_are_not(spark):
    rng, items = made(2)
    docs, want = [], set()
    noise = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    for k, (item, text) in enumerate(items):
        w = text.split()
        forms = {
            0: text.upper(),
            1: " ".join(w[10:34]),
            2: "\n".join(" ".join(w[i : i + 5]) + ("\nB:" if i % 2 else " [01:0%d]" % (i % 10)) for i in range(0, 60, 5)),
            3: " ".join(x if i % 9 else "zzz" for i, x in enumerate(w)),
            4: " ".join(w[:20]) + " " + noise(25) + " " + " ".join(w[20:45]),
            5: "".join(chr(ord(c) + 0xFEE0) if c.isalpha() else c for c in text),
            6: text.replace("a", "а").replace("o", "ο").replace("i", "і"),
            7: "­".join(text),
            8: "; ".join(w),
        }
        docs.append((k, noise(30) + " " + forms[k % 9] + " " + noise(30)))
        want.add((k, item))
    docs += [(50 + k, " ".join(" ".join(t.split()[7 * j : 7 * j + 7]) + " " + noise(6) for j in range(0, 8, 2))) for k, (_, t) in enumerate(items[:6])]
    docs += [(90, None), (91, ""), (None, items[0][1]), (0, docs[0][1]), (92, noise(30_000))]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "'x' AS item_id")
    i = spark.createDataFrame([*items, items[0], (7, None), (8, "too short to leak")], "item_id bigint, text string")
    got = leaks.leaked_passages(d, "doc_id", "text", i, "item_id", "text").collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == sorted(want)
    texts, by = dict(x for x in docs if x[0] is not None), dict(items)
    for r in got:
        span = leaks.fold(texts[r.doc_id][r.start_char : r.end_char]).split()
        assert len(set(span) & set(leaks.fold(by[r.item_id]).split())) >= 12
    assert leaks.leaked_passages(d.limit(0), "doc_id", "text", i, "item_id", "text").count() == 0
    assert leaks.leaked_passages(d, "doc_id", "text", i.limit(0), "item_id", "text").count() == 0


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    _, items = made(3)
    d = spark.createDataFrame([(k, "before " + t + " after") for k, (_, t) in enumerate(items)], "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(leaks, "ITEMS_AT_ONCE", 6)
    got = {(r.doc_id, r.item_id) for r in leaks.leaked_passages(d, "doc_id", "text", i, "item_id", "text").collect()}
    assert got == {(k, item) for k, (item, _) in enumerate(items)}


def test_offsets_point_into_the_original():
    _, items = made(4)
    p = leaks.Passages(items)
    text = "Ｎｏｔｅ​… " + items[3][1].upper() + " tail"
    (item, n, a, b), = leaks.passages_in(text, p)
    assert item == items[3][0] and n == 60 and leaks.fold(text[a:b]).split() == leaks.fold(items[3][1]).split()


def test_single_changed_words_do_not_hide_a_passage():
    rng, items = made(5)
    p = leaks.Passages(items)
    w = items[0][1].rstrip(".").split()
    around = lambda x: " ".join(rng.choice(WORDS) for _ in range(20)) + " " + x + " " + " ".join(rng.choice(WORDS) for _ in range(20))
    changed = lambda a, b, at: " ".join("zzz" if i in at else w[i] for i in range(a, b))
    for a, b, at in ((0, 17, {8}), (5, 25, {11, 18}), (30, 53, {36, 42, 48}), (10, 34, {14, 19, 24, 29}), (20, 41, {26, 31, 36}), (0, 60, set(range(2, 60, 3)))):
        hits = leaks.passages_in(around(changed(a, b, at)), p)
        assert [(h[0], h[1] >= b - a - len(at)) for h in hits] == [(items[0][0], True)], (a, b)
    assert leaks.passages_in(around(changed(0, 8, ())) + " " + around(changed(30, 38, ())), p)[0][1] == 16
    assert leaks.passages_in(around(changed(0, 15, ())), p) == []
    assert leaks.passages_in(" ".join(around(changed(a, a + 7, ())) for a in (0, 14, 28, 42)), p) == []


def test_another_sentence_of_a_template_is_not_a_passage():
    say = "so {} voices filled the {} while the {} showed a warning my {} felt {} and {} folded {} carpets before {} near the {} bridge"  # no phrase of eight words
    item, other = (say.format(*(f"{c}{k}" for k in range(9))) for c in ("one", "two"))
    assert leaks.passages_in(other, leaks.Passages([(1, item)])) == []


def test_parts_are_linked_over_any_number_of_stray_runs():
    _, items = made(6)
    w = items[0][1].rstrip(".").split()
    head, part = " ".join(w[:6]), w[20:36]
    heads = lambda x: " ".join([head, *(f"{x}{k}" for k in range(7))] * 9)
    item = heads("one") + " " + " ".join(part)
    p = leaks.Passages([(1, item)])
    text = " ".join(part[:8]) + " " + heads("two") + " " + " ".join(part[8:])
    (_, n, a, b), = leaks.passages_in(text, p)
    assert (n, text[a:b]) == (16, text)


def test_best_before_a_place_against_a_loop():
    rng = random.Random(7)
    tree, put = leaks._Best(), []
    for _ in range(400):
        x = rng.randrange(1, 300)
        assert tree.upto(x) == max((v for q, v in put if q <= x), default=None)
        put.append((rng.randrange(1, 300), (rng.randrange(50), rng.randrange(50))))
        tree.put(*put[-1])


def altered(rng, w, n, changed, inserted):
    """A stretch of an item with single words changed and put in, ``n`` of the item's words left."""
    at = rng.randrange(0, len(w) - n - changed + 1)
    part = w[at : at + n + changed]
    places = sorted(rng.sample(range(1, len(part) - 1), changed))
    while any(b - a < 3 for a, b in zip(places, places[1:], strict=False)):  # single words: two of the passage between them
        places = sorted(rng.sample(range(1, len(part) - 1), changed))
    out = [f"zz{rng.randrange(99)}" if i in places else x for i, x in enumerate(part)]
    for _ in range(inserted):
        out.insert(rng.randrange(1, len(out)), f"yy{rng.randrange(99)}")
    return out


def test_recall_over_generated_alterations():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(4000)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice((26, 40, 90))))) for k in range(40)]
    p = leaks.Passages(items)
    found = {"changed": [], "inserted": [], "both": [], "long": []}
    for trial in range(400):
        item, text = items[trial % 40]
        w = text.split()
        kind = list(found)[trial % 4]
        changed, inserted = {"changed": (rng.randrange(1, 5), 0), "inserted": (0, rng.randrange(1, 4)), "both": (2, rng.randrange(1, 3)), "long": (rng.randrange(0, 3), 0)}[kind]
        left = 18 if kind == "both" else 17 if kind == "inserted" else 16  # a word cut off by two put in may not count
        part = altered(rng, w, left, changed, inserted)
        around = 20_000 if kind == "long" and trial < 40 else 60
        doc = [rng.choice(vocabulary) for _ in range(around)]
        at = rng.randrange(around)
        found[kind].append(item in {h[0] for h in leaks.passages_in(" ".join([*doc[:at], *part, *doc[at:]]), p)})
    assert all(sum(x) / len(x) >= (0.99 if k in ('changed', 'long') else 0.95) for k, x in found.items()), {k: sum(x) / len(x) for k, x in found.items()}


def test_ids_of_any_type_and_several_texts_of_one_id(spark):
    _, items = made(12)
    d = spark.createDataFrame([(f"d{k}", "before " + items[k][1] + " after") for k in range(4)], "doc string, body string")
    i = spark.createDataFrame([("x", items[0][1]), ("x", items[1][1]), ("y", items[2][1]), ("y", None), (None, items[3][1])], "name string, body string")
    got = leaks.leaked_passages(d, "doc", "body", i, "name", "body")
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {("d0", "x"), ("d1", "x"), ("d2", "y")}
    assert dict(got.dtypes)["item_id"] == "string"


def test_a_table_of_look_alikes_can_be_read(spark):
    lines = ["﻿# comment", "0430 ;\t0061 ;\tMA\t# a", "AB70 ; 0044 ; MA", "0031 ; 006C ; MA # a digit", "FF41 ; 0061 ; MA # width", "0251 ; 0430 ; MA # by way of another", "01C4 ; 0044 017D ; MA # two", "broken"]
    look = confusables.load(lines)
    assert look == {0x430: "a", 0xAB70: "D", 0x251: "a"}
    table = spark.createDataFrame([("а", "a"), ("xx", "y"), (None, "z")], "s string, p string")
    assert confusables.look_alikes_of(table, "s", "p") == {0x430: "a"}
    df = spark.createDataFrame([(1, "cаt"), (2, "cat"), (3, "сat")], "id bigint, t string")  # а and с of another script
    assert {tuple(r) for r in confusables.twins(df, "id", "t", look).collect()} == {(1, 2)}
    assert {tuple(r) for r in confusables.twins(df, "id", "t").collect()} == {(1, 2), (1, 3), (2, 3)}
    assert confusables.skeleton("ᎪᏴᏟ Ⲟ ɩ σ ꞌ ı") == "ABC O i o ' i"


def test_much_copied_twins_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(confusables, "COPIES_A_TASK", 3)
    df = spark.createDataFrame([(k, ("cаt", "cat", "dog")[k % 3]) for k in range(30)], "id bigint, t string")
    got = {tuple(r) for r in confusables.twins(df, "id", "t").collect()}
    assert got == {(min(a, b), max(a, b)) for a in range(0, 30, 3) for b in range(1, 30, 3)}
    classes = {r.id: (r.class_id, r.form_id, r.n_forms, r.n_copies) for r in confusables.twin_classes(df, "id", "t").collect()}
    assert classes == {k: (0, k % 3, 2, 10) for k in range(30) if k % 3 < 2}
    assert confusables.twin_classes(df.limit(0), "id", "t").count() == 0
