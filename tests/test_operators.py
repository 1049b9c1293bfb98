"""Retrieval, components, evaluation and the review queue against brute force and documented cases."""

import datetime as dt
import random
import re

from authlens.operators import evaluation
from authlens.operators.components import components, story_copies
from authlens.operators.retrieval import best_of_searches, top_candidates, trigram_pairs
from authlens.operators.review import leases, replay


def grams(t):
    return {f"  {w} "[i:i + 3] for w in re.split(r"\W+", t.lower()) if w for i in range(len(w) + 1)}


def test_grams_and_pairs(spark):
    assert grams("ab") == {"  a", " ab", "ab "}
    names = ["Zorwin Kael", "Zorwin Tarn", "Zorvin Kael", "Kael, Zorwin", "!!!", "qu", "qux", "海城 电影"]
    df = spark.createDataFrame([("P", n) for n in [*names, None]], "kind string, name string")
    got = {(r.lname, r.rname): r.similarity for r in trigram_pairs(df, df).collect()}
    want = {}
    for a in names:
        for b in names:
            x, y = grams(a), grams(b)
            if x and y and len(x & y) / len(x | y) >= 0.3:
                want[a, b] = round(len(x & y) / len(x | y), 6)
    assert got == want


def test_top_candidates_leaves_out_inactive_and_other_kinds(spark):
    recs = [("1", "Zorwin Kael", "PERSON", True, None), ("2", "Kael Zorwin", "PERSON", True, "1"), ("3", "Zorwin Kael", "AWARD", True, None), ("4", "Zorwin Kael", "PERSON", False, None), ("5", "Zorwin Kaels", "PERSON", True, "gone")]
    recs = spark.createDataFrame(recs, "uid string, name string, kind string, is_active boolean, canonical_uid string")
    hits = top_candidates(spark.createDataFrame([(7, "PERSON", "Zorwin Kael"), (8, "PERSON", None)], "id long, kind string, name string"), recs).collect()
    assert {(r.id, r.uid) for r in hits} == {(7, "1")}
    # a name that leads to no record keeps its place
    assert sorted(r.place for r in hits) == [1, 2]
    assert top_candidates(spark.createDataFrame([], "id long, kind string, name string"), recs).count() == 0


def test_steps_of_a_search_lose_nothing(spark):
    rng = random.Random(3)
    syl = "dre kal mun vor eth sha lin pol".split()
    names = sorted({"".join(rng.choice(syl) for _ in range(3)) + " " + "".join(rng.choice(syl) for _ in range(2)) for _ in range(120)})
    recs = spark.createDataFrame([(f"u{i:03}", n, "P", True, None) for i, n in enumerate(names)], "uid string, name string, kind string, is_active boolean, canonical_uid string")
    asked = names[::7]
    got = {}
    for r in top_candidates(spark.createDataFrame([(i, "P", n) for i, n in enumerate(asked)], "id long, kind string, name string"), recs, k=3).collect():
        got.setdefault(asked[r.id], []).append((r.place, r.name, r.similarity))
    for n in asked:
        sims = sorted(((-round(len(grams(n) & grams(m)) / len(grams(n) | grams(m)), 6), m) for m in names if len(grams(n) & grams(m)) / len(grams(n) | grams(m)) >= 0.3))[:3]
        assert [(m, s) for _, m, s in sorted(got[n])] == [(m, -s) for s, m in sims]


def test_best_of_searches(spark):
    hit = spark.createDataFrame([(1, "u", 0.5)], "id long, uid string, similarity double")
    assert best_of_searches(hit, spark.createDataFrame([(1, "u", 1.0)], hit.schema)).first().similarity == 0.9


def test_components_and_copies(spark):
    nodes = spark.createDataFrame([(i,) for i in range(12)], "id long")
    links = spark.createDataFrame([(i, i + 1) for i in range(6)] + [(9, 8), (3, None), (2, 99)], "a long, b long")
    assert {r.id: r.root for r in components(links, nodes).collect()} == {**{i: 0 for i in range(7)}, 7: 7, 8: 8, 9: 8, 10: 10, 11: 11}
    day = lambda n: dt.datetime(2026, 1, n)
    art = [(1, "https://www.channelnewsasia.com/s/slug-7000001", "T one", day(1)), (2, "https://www.channelnewsasia.com/other/new-7000001", "Other", day(9)), (3, "https://www.a.x/b/z", "Same", day(1)), (4, "https://www.a.x/b/y", "same ", day(2)), (5, "https://www.b.x/b/q", "same", day(2)), (6, "https://a.x/c/1", "Col", day(1)), (7, "https://a.x/c/2", "Col", day(2)), (8, "https://a.x/c/3", "Col", day(3)), (9, "https://a.x/d", None, None)]
    df = spark.createDataFrame(art, "id long, url string, title string, pubdate timestamp").selectExpr("*", "pubdate as created_at")
    assert {r.id: r.original for r in story_copies(df.union(df)).collect()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9}


def test_allocation_and_metrics(spark):
    strata = spark.createDataFrame([("p", 37), ("q", 411), ("r", 1552), ("s", 0)], "stratum string, size long")
    share = lambda n: {r.stratum: r.share for r in evaluation.allocate(strata, n).collect()}
    # 0.35, 3.90, 14.75: the rest goes to the largest fractions
    assert share(19) == {"p": 0, "q": 4, "r": 15, "s": 0}
    # more than there is
    assert share(5000) == {"p": 37, "q": 411, "r": 1552, "s": 0}
    rng = random.Random(1)
    rows = [(rng.randrange(2), rng.randrange(8)) for _ in range(80)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "label int, score int")
    assert abs(evaluation.rank_auc(df).first().auc - auc) < 1e-6
    f1 = max(2 * sum(s >= t for s in pos) / (sum(s >= t for _, s in rows) + len(pos)) for t in range(8))
    assert abs(evaluation.best_f1(df).first().f1 - f1) < 1e-6
    drawn = evaluation.draw(spark.createDataFrame([("x", i) for i in range(9)], "s string, id long"), ["s"], "id", 3).collect()
    assert len(drawn) == 3 and drawn[0].weight == 3


def test_leases_and_replay(spark):
    at = lambda m: dt.datetime(2026, 1, 1) + dt.timedelta(minutes=m)
    ev = spark.createDataFrame([(1, at(0), 5), (2, at(50), 5), (3, at(120), 5)], "event_id long, ts timestamp, user_id long")
    assert sorted((r.lease, r.events) for r in leases(ev).collect()) == [(1, 2), (2, 1)]
    cmds = [(1, 1, 10, "view", at(0)), (1, 2, 11, "view", at(5)), (1, 3, 10, "click", at(50)), (1, 4, 11, "view", at(100)), (1, 5, 11, "purchase", at(101)), (1, 6, 11, "view", at(115)), (1, 7, 11, "purchase", at(116)), (1, 8, 10, "view", at(300))]
    done = {r.seq: r.done for r in replay(spark.createDataFrame(cmds, "card long, seq long, user long, verb string, ts timestamp")).collect()}
    assert done == {1: True, 2: False, 3: True, 4: False, 5: False, 6: True, 7: True, 8: False}


def test_entry_and_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_gazetteer_of_forms_and_ideographs(spark, tmp_path):
    import __spark_entry__ as entry

    texts = [(1, "昨日海城电影会开幕"), (2, "So said Zurn Norrlelk of the Harbour Union."), (3, None), (4, "海城 电影"), (5, "met Norrlelk Zurn, Kexglun Film")]
    names = [("u1", "海城电影会"), ("u2", "Norrlelk, Zurn"), ("u3", "Harbour Union (Northern)"), ("u4", "Dr. Kexglun Film"), ("u5", "海城"), ("u6", None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(names, "uid string, name string").write.parquet(f"{tmp_path}/entities.parquet")
    spark.createDataFrame([(3, "the Harbour Union (Northern) met"), (4, None)], "id long, evidence string").write.parquet(f"{tmp_path}/extracted_entities.parquet")
    got = {tuple(r) for r in entry.queries()["gazetteer_forms"](spark, str(tmp_path)).collect()}
    assert got == {("u1", 1, 1), ("u2", 2, 2), ("u3", 1, 2), ("u4", 1, 5)}
    assert {tuple(r) for r in entry.queries()["gazetteer"](spark, str(tmp_path)).collect()} == {("u2", 1, 5), ("u3", 1, -3)}


def test_each_article_has_one_original(spark):
    at = lambda d, h=0: dt.datetime(2026, 3, d, h)
    art = [
        (1, "https://x.y/a", "One", at(1)), (2, "https://x.y/b", "Two", at(1)),
        # the third has the first's title, the fourth the second's address: neither joins both
        (3, "https://x.y/c", "One", at(2)), (4, "https://x.y/b/", "One", at(9)),
        # a copy of a copy finds the first; three days on the title is a new story
        (5, "https://x.y/d", "ONE ", at(4)), (6, "https://x.y/e", "one", at(3, 5)), (7, "https://x.y/f", None, None), (8, "https://x.y/g", "", None),
    ]
    df = spark.createDataFrame(art, "id long, url string, title string, pubdate timestamp").selectExpr("*", "pubdate as created_at")
    got = {r.id: r.original for r in story_copies(df).collect()}
    # the title is used on four days and so is a column
    assert got == {1: 1, 2: 2, 3: 3, 4: 2, 5: 5, 6: 6, 7: 7, 8: 8}
    got = {r.id: r.original for r in story_copies(df.filter("id not in (4, 5, 6)")).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 7: 7, 8: 8}
    assert story_copies(df.limit(0)).count() == 0


def test_thresholds_and_precision(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(2), rng.randrange(12) / 8, i, "ab"[i % 2]) for i in range(90)]
    df = spark.createDataFrame(rows, "label int, score double, id long, part string")
    order = sorted(rows, key=lambda r: (-r[1], r[2]))
    hits, ap = 0, []
    for n, r in enumerate(order, 1):
        hits += r[0]
        if r[0]:
            ap.append(hits / n)
    assert abs(evaluation.average_precision(df, "id").first().ap - sum(ap) / len(ap)) < 1e-6
    t = evaluation.prf(df, __import__("pyspark").sql.functions.lit(0.5)).first()
    assert (t.tp, t.fp) == (sum(r[0] for r in rows if r[1] >= 0.5), sum(1 - r[0] for r in rows if r[1] >= 0.5))
    assert evaluation.prf(df.limit(0), __import__("pyspark").sql.functions.lit(0.5)).first().precision is None
    pos = sum(r[0] for r in rows)
    best = max(sum(r[0] for r in rows if r[1] >= s) / sum(r[1] >= s for r in rows) for s in {r[1] for r in rows} if sum(r[0] for r in rows if r[1] >= s) >= 0.8 * pos)
    assert abs(evaluation.precision_at_recall(df, 0.8).first().precision - best) < 1e-6
    # one score only, and none
    assert evaluation.best_f1(spark.createDataFrame([(1, 0.5), (0, 0.5)], "label int, score double")).first().threshold == 0.5
    assert evaluation.best_f1(df.limit(0)).count() <= 1


def test_intervals_hold_what_they_should(spark):
    got = {r.group: r.inside for r in evaluation.coverage(spark, [("often", 4000, 0.8, 150), ("seldom", 9000, 0.02, 200)], 300).collect()}
    assert all(0.9 <= v <= 1 for v in got.values())
    rng = random.Random(2)
    units = [(f"a{i}", "g", 1.0, rng.randrange(1, 5), rng.randrange(2), rng.randrange(2)) for i in range(80)]
    df = spark.createDataFrame(units, "key string, `group` string, weight double, ok int, bad int, missed int")
    for r in evaluation.cluster_range(df, "key", redraws=400).collect():
        rest = 4 if r.measure == "precision" else 5
        point = sum(u[3] for u in units) / sum(u[3] + u[rest] for u in units)
        assert abs(r.point - point) < 1e-9 and r.lo < point < r.hi < r.lo + 0.3
    again = [tuple(r) for r in evaluation.cluster_range(df.repartition(7), "key", redraws=400).orderBy("measure").collect()]
    assert [round(x, 9) for r in again for x in r[1:]] == [round(x, 9) for r in evaluation.cluster_range(df, "key", redraws=400).orderBy("measure").collect() for x in r[1:]]
    groups = spark.createDataFrame([(120.0, 40, 30, True), (900.0, 60, 0, False), (50.0, 0, 0, False)], "size double, labelled long, yes long, kept boolean")
    r = evaluation.recall_range(groups, "kept").first()
    assert r.recall == 1.0 and 0.4 < r.lo < r.hi <= 1


def test_search_moves_names_and_answers_not_pairs(spark):
    """1,500 names that share most grams would be 2,250,000 pairs."""
    names = [(f"u{i}", f"Harbour Guild Council {i}", "P", True, None) for i in range(1500)]
    recs = spark.createDataFrame(names, "uid string, name string, kind string, is_active boolean, canonical_uid string")
    asked = spark.createDataFrame([(i, "P", f"Harbour Guild Council {i}") for i in range(1500)], "id long, kind string, name string")
    moved = lambda: spark._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    before = moved()
    rows = top_candidates(asked, recs).collect()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    assert moved() - before < 5_000_000
    assert len(rows) == 7500 and {r.similarity for r in rows if r.place == 1} == {1.0}


def test_search_in_blocks_and_shares(spark, monkeypatch):
    from authlens.operators import retrieval

    monkeypatch.setattr(retrieval, "HELD", 40)
    monkeypatch.setattr(retrieval, "ASKED", 15)
    rng = random.Random(5)
    syl = "dre kal mun vor eth sha lin pol".split()
    names = sorted({"".join(rng.choice(syl) for _ in range(3)) + " " + rng.choice(syl) for _ in range(150)} | {" ".join(f"{syl[i % 8]}{i}" for i in range(j, j + 90)) for j in (0, 5)})
    recs = spark.createDataFrame([(f"{kind}{i:03}", n, kind, True, None) for kind in ("P:1", "Q") for i, n in enumerate(names) if (i % 2 or kind == "Q")], "uid string, name string, kind string, is_active boolean, canonical_uid string")
    asked = [(i, kind, n) for i, n in enumerate(names) for kind in ("P:1", "Q", "R")] + [(999, "Q", "!!"), (998, None, "dre")]
    df = spark.createDataFrame(asked, "id long, kind string, name string")
    for k, floor in ((5, 0.3), (2, 0.6)):
        got, want = {}, {}
        for r in top_candidates(df, recs, k, floor).collect():
            got.setdefault((r.id, r.uid[:-3]), []).append((r.place, r.name, r.similarity))
        for i, kind, n in asked[:-2]:
            held = [m for j, m in enumerate(names) if kind == "Q" or (kind == "P:1" and j % 2)]
            sims = sorted((-round(len(grams(n) & grams(m)) / len(grams(n) | grams(m)), 6), m) for m in held)
            if found := [(p, m, -s) for p, (s, m) in enumerate(sims[:k], 1) if -s >= floor]:
                want[i, kind] = found
        assert {x: sorted(v) for x, v in got.items()} == want
