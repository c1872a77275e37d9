import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pavelens.llm import leakage, lines, quality


def _brute(docs, items, need):
    grams = {}
    for i, t in items:
        w = leakage.words(t)
        for k in range(len(w) - need + 1):
            grams.setdefault(tuple(w[k : k + need]), set()).add(i)
    out = set()
    for d, t in docs:
        w = leakage.words(t)
        for k in range(len(w) - need + 1):
            out |= {(i, d) for i in grams.get(tuple(w[k : k + need]), ())}
    return out


def _case(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Größe", "ＦＵＬＬ", "the"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.randrange(5, 60))) for i in range(30)] + [(90, None), (91, ""), (92, "Question: short?")]
    docs = []
    for d in range(200):
        t = text(rnd.randrange(80))
        if d % 2 == 0:
            w = leakage.words(rnd.choice(items[:30])[1])
            k, n = rnd.randrange(max(1, len(w) - 12)), rnd.choice([10, 11, 12, 13, 30])
            t += "\r\n+ " + rnd.choice(["  ", "_", "\n> ", "-"]).join(x.upper() for x in w[k : k + n]) + " | " + text(9)
        docs.append((d, t))
    return docs + [(900, None), (901, ""), (902, text(40_000) + " " + items[0][1] + " " + items[0][1]), docs[0]], items


@pytest.mark.parametrize("blocks", [1 << 24, 300])
def test_leaks_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(leakage, "BLOCK_CHARS", blocks)
    docs, items = _case(3)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    i = spark.createDataFrame(items + items[:2], "item_id long, item_text string")
    want = _brute(docs, items, 12)
    got = leakage.find_leaks(d, i, leakage.LeakRules(rank=8, centres=16)).collect()
    assert len(want) > 40 and sorted((r["item_id"], r["doc_id"]) for r in got) == sorted(want)
    assert all(r["cosine"] > 0.99 for r in got)


def test_nothing_to_find(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, item_text string")
    some = spark.createDataFrame([(1, "a " * 50)], "item_id long, item_text string")
    assert leakage.find_leaks(docs, items).count() == 0 and leakage.find_leaks(docs, some).count() == 0
    assert leakage.find_leaks(some.toDF("doc_id", "text"), items).count() == 0


def test_paraphrases(spark):
    rnd = random.Random(4)
    vocab = [f"v{i}" for i in range(300)]
    base = [rnd.choice(vocab) for _ in range(24)]
    near = list(base)
    for k in (2, 7, 12, 17):
        near[k] = "other"
    items = [(1, " ".join(base) + "\nAnswer: blue moon")]
    docs = [(1, " ".join(near) + " blue moon"), (2, " ".join(near)), (3, " ".join(rnd.choice(vocab) for _ in range(24))), (4, " ".join(sorted(base)))]
    docs += [(k, " ".join(f"f{rnd.randrange(900)}" for _ in range(40))) for k in range(10, 210)]  # a corpus in which the item's words are rare
    got = {r["doc_id"]: r for r in leakage.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, item_text string"), leakage.PARAPHRASE).collect()}
    assert set(got) == {1, 2} and got[1]["answer_found"] and not got[2]["answer_found"]


def test_the_answer_decides_below_the_bound(spark):
    base = [f"v{k}" for k in range(24)]
    near = lambda n: " ".join(f"x{k}" if 6 <= k < 6 + n else w for k, w in enumerate(base))
    docs = [(n, near(n) + " y y blue moon") for n in (8, 10, 11)] + [(100 + n, near(n) + " y y blue sky") for n in (8, 10)]
    got = leakage.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(base) + "\nAnswer: blue moon")], "item_id long, item_text string"), leakage.PARAPHRASE).collect()
    assert {(r["doc_id"], r["shared"], r["answer_found"]) for r in got} == {(8, 16, True), (10, 14, True), (108, 16, False)}


@pytest.mark.parametrize("replaced", [1, 2, 4, 6, 8])
def test_recall_of_passages_at_random_places(spark, replaced):
    rnd = random.Random(replaced)
    items = [[f"w{rnd.randrange(900)}" for _ in range(rnd.randrange(30, 70))] for _ in range(20)]
    docs = []
    for d in range(100):
        item = items[d % 20]
        k = rnd.randrange(len(item) - 23)
        w = item[k : k + 24]
        for j in rnd.sample(range(24), replaced):
            w[j] = f"x{rnd.randrange(99)}"
        docs.append((d, " ".join([f"y{rnd.randrange(99)}" for _ in range(rnd.randrange(60))] + w + [f"z{rnd.randrange(99)}" for _ in range(rnd.randrange(60))])))
    got = leakage.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, item_text string"), leakage.PARAPHRASE)
    assert {(r["item_id"], r["doc_id"]) for r in got.collect()} >= {(d % 20, d) for d in range(100)}  # recall 1


def _shares(doc, item, need, size):
    a, b = leakage.windows(doc, size, 1, need), leakage.windows(item, size, 1, need)
    i, j = (g.ravel() for g in np.meshgrid(range(len(a)), range(len(b))))
    return bool(len(i)) and leakage.longest_subsequence(a[i], b[j]).max() >= need


def _reworded(seed, at=0):
    """Documents with an item's 24 words from place `at` on, 0 to 9 of them replaced by words of no item."""
    rnd = random.Random(seed)
    base = [[f"w{rnd.randrange(400)}" for _ in range(48)] for _ in range(4)]
    docs = []
    for d in range(60):
        w = list(base[d % 4][at : at + 24])
        for k in rnd.sample(range(24), d % 10):
            w[k] = f"x{rnd.randrange(99)}"
        docs.append((d, " ".join([f"y{k}" for k in range(d % 12 if at else 0)] + w)))
    return docs, [(i, " ".join(b)) for i, b in enumerate(base)]


def _found_and_wanted(spark, docs, items):
    number = {w: k + 1 for k, w in enumerate(sorted({w for _, t in items for w in t.split()}))}
    ids = lambda t: np.array([number.get(w, 0) for w in t.split()], np.int32)
    want = {(i, d) for d, t in docs for i, x in items if _shares(ids(t), ids(x), 16, 24)}
    got = leakage.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, item_text string"), leakage.PARAPHRASE)
    return {(r["item_id"], r["doc_id"]) for r in got.collect()}, want


def test_paraphrases_with_foreign_words(spark):
    got, want = _found_and_wanted(spark, *_reworded(5))
    assert len(want) == 54 and got == want  # all but those with nine words replaced


def test_paraphrases_off_the_grid(spark):
    got, want = _found_and_wanted(spark, *_reworded(6, at=7))
    assert len(want) == 54 and got == want


def test_sample_is_taken_from_kept_documents(spark, monkeypatch):
    seen, basis = [], leakage.latent_basis
    monkeypatch.setattr(leakage, "latent_basis", lambda passages, *rest: (seen.append(passages.count()), basis(passages, *rest))[1])
    text = " ".join(f"w{k}" for k in range(14))
    docs = [(k, text if k % 10 == 0 else "other") for k in range(300)]
    leakage.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, text)], "item_id long, item_text string"), leakage.LeakRules(sample_docs=30))
    assert seen == [31]  # the item and all of the 30 documents that can match


def test_common_words_of_windows():
    a, b = np.array([[1, 2, 3, 4, 5, 0]]), np.array([[9, 1, 2, 3, 0, 4]])
    assert leakage.longest_run(a, b).tolist() == [3] and leakage.longest_subsequence(a, b).tolist() == [4]
    assert leakage.words("It's ½ Fuß_x ＡＢ é") == ["it", "s", "1", "2", "fuß", "x", "ab", "é"]


LINES = {
    "list": ["- fix the thing", "  * item", "• x y", "1. first of all", "2) two", "(c) three", "- [ ] open", "- [x] done", "☐ box"],
    "table": ["| a | 12 | b |", "|---|---|", "+-----+----+", "a\tb\t12%", "row    12.5    old", "tile;19796;0.115;95.300", " name       7%     new"],
    "junk": [r"\x26\xde\xc0\x1e\x04\xf4", "zs8W?g<+*{<$Dit3WB`6KeX9?0nlLHU@Yl&M2Lf|D", "VxIytaClYKNZO6v801wewM7fiqdVsdTCATmTU0KW60FeuO8YE0s0YL", "~~~~~~~~~~~~~~", "Ã�™€¤€Ÿ €ŸÃŸ¶xx€x� Ã€Ã™™", "Ÿâ¤ x¤¤�â¶¶€¼¶¶Ÿâ¤�x  €¤�� â¤x™ ", "fqjogjiuopjqqkj'e owsdujalipgdodw hgfdsk", "4f2a 99c1 00ff 7e7e 1234 aaaa beef 0000"],
    "none": ["Every first dialog waits for the remote mutex, because it is late.", "commit 5a5177cb4ae1e85a568fb301866a9385ee6f2184", "Author: a b <a@b.example>", "Signed-off-by: a <a@b.c>", "src/a/b_c.py", "\tflag/tile_id.rs", "diff --git a/x b/x", "GIT binary patch", "literal 532", "r52180 | oz | Thu Jul 4 08:35:28 2024 +0100 | 6 lines", "ｔｈｅ ｗｅａｓｅｌ, ａｎｄ 27 ｓｉｌｖｅｒ ｓａｄｄｌｅｓ ｎｅａｒ ｉｔ", "Der alte Takt erzeugt keinen Messpunkt, obwohl er noch wartet."],
}


@pytest.mark.parametrize("kind, line", [(k, x) for k, v in LINES.items() for x in v])
def test_line_kinds(kind, line):
    assert lines.KINDS[lines.line_kinds(line)[0]] in ((kind, "doubtful") if kind == "junk" else (kind,))


def test_hunks_are_no_lists():
    text = "feat: x\r\n\r\n@@ -1,3 +1,3 @@\r\n - a\r\n- b\r\n+ c\r\n - d\r\n- item after the hunk\r\n- another\r\n"
    assert [lines.KINDS[k] for k in lines.line_kinds(text)] == ["none"] * 6 + ["list", "list"]


def test_the_distance_tells_names_from_junk(spark):
    rnd = random.Random(8)
    some = ["The old road is under the bridge and we do not want to close it in the winter because the snow is near.", "the road is by the bridge and the winter is near, so we wait here for it to go by them", "closed bridges repaired near the station", "New signs are set up. The gate is shut."]
    docs = [(i, "\n".join(rnd.choice(some) for _ in range(rnd.randrange(1, 16)))) for i in range(900)]
    odd = "Vjztk Grzmq Zbcz."  # letters that hardly form words
    names = "\n".join(f"{odd}\nthe road is by the bridge and the winter is near, so we wait here for it to go by them" for _ in range(6)) + f"\n{odd}"
    docs += [(2000, names), (2001, "\n".join("vjztkgrzmqzbczqxjkwpv zbtrjqkkvz wqxzjgkpvvbc" for _ in range(6)))]
    got = {r["id"]: r for r in quality.quality(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    a, b = got[2000], got[2001]
    assert a["doubtful_lines"] > 0.5 and a["junk_lines"] > 0.5 and b["doubtful_lines"] > 0.5
    assert a["words2"] < quality.CHI2_MEDIAN < b["words2"]
    assert a["klass"] is None and b["klass"] == "junk"  # by their lines alone both would be junk


def test_quality(spark):
    rnd = random.Random(6)
    prose = {
        "en": "The old road is under the bridge and we do not want to close it in the winter because the snow is near.",
        "de": "Die alte Straße ist unter der Brücke und wir sperren sie nicht im Winter, weil der Schnee noch da ist.",
    }
    docs = [(i, "\n".join(prose["en" if i % 4 else "de"] for _ in range(rnd.randrange(2, 9)))) for i in range(900)]
    docs += [(2000, "- a\n" * 9 + "The end."), (2001, "a | b | c | d\n" * 9), (2002, r"\x26\xde\xc0\x1e" "\n"), (2003, None), (2004, ""), (2005, "\n \n"), (2006, prose["en"] * 20_000), (2007, "- a\nb is the c")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("klass", F.lit("clash"))
    got = {r["id"]: r for r in quality.quality(df).collect()}
    assert len(got) == len(docs)
    assert {i: r["klass"] for i, r in got.items() if r["klass"]} == {2000: "list", 2001: "table", 2002: "junk"}
    assert got[0]["model"] == "de" and got[1]["model"] == "en" and got[2003]["language"] == "und"
    for r in got.values():
        assert abs(sum(r[f"part_{s}"] for s in quality.STATISTICS) - r["distance2"]) < 1e-6 * (1 + r["distance2"])
        assert not (max(r[s] for s in quality.KINDS.values()) > 0.5 and r["klass"] is None)
    assert np.median([r["distance2"] for i, r in got.items() if i < 900]) < quality.CHI2_BOUND
    assert quality.quality(df.limit(0)).count() == 0
