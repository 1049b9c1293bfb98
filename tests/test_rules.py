"""Rules on names, values, pages, feeds, answers and rewrites: odd cases of each."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from authlens.functions import fields as FL
from authlens.functions import names as N
from authlens.functions import text as T
from authlens.operators import cards as C
from authlens.operators import dealing, edits, reach
from authlens.sources import answers, feeds, pages, parts


def each(spark, rule, *cases):
    """Results of a column function on cases (tuples of its arguments, strings or None), in order."""
    rows = [(i, *(c if isinstance(c, tuple) else (c,))) for i, c in enumerate(cases)]
    names = [f"a{i}" for i in range(len(rows[0]) - 1)]
    df = spark.createDataFrame(rows, "i long, " + ", ".join(f"{n} string" for n in names))
    return [r.x for r in df.select("i", rule(*map(F.col, names)).alias("x")).orderBy("i").collect()]


def test_names(spark):
    assert each(spark, N.plain, "  The　“Old”  Mill’s ", "STRASSE ß", "", None) == ["the \"old\" mill's", "strasse ss", "", None]
    house = ["The Harbour Guild (Singapore)", "Singapore. Board of Weavers", "Weavers & Dyers' Union (WDU)", "Mayor's Awards", "Guild, Singapore"]
    assert each(spark, N.house, *house) == ["harbour guild", "board of weavers", "weavers and dyers union", "mayor award", "guild"]
    assert each(spark, N.without_year, "Prize (1998)", "1998 Prize 2101") == ["Prize", "Prize 2101"]
    assert each(spark, N.renamed, ("Old Prize (2004) ", "Prize"), ("Old Prize", "Prize")) == ["Prize (2004)", "Prize"]
    assert each(spark, N.tries_for, "海城奖 (Harbour (Grand) Prize)", "Harbour Prize (海城奖) (2001)", "Harbour Prize (HP)") == [["海城奖", "Harbour (Grand) Prize"], ["海城奖", "Harbour Prize"], ["Harbour Prize (HP)"]]
    assert each(spark, N.english, "海城奖 (Harbour Prize) (2004)", "Société (Company)", "Plain") == ["Harbour Prize (2004)", "Société (Company)", "Plain"]
    assert each(spark, N.news_values, "A Prize (甲), B Prize (乙)， C | Lim, Ana", " | ", None) == [["A Prize (甲)", "B Prize (乙)", "C", "Lim, Ana"], [], []]
    assert each(spark, lambda f, v: N.clean_news_value(f, v), ("Awards", "Star | 高级律师 (Senior Counsel)"), ("Street Address", "山路 (Hill Road) | 山路"), ("Description", "a | b")) == ["Star", "Hill Road", "a | b"]
    assert each(spark, N.loose_name, "The Old-Mill, Inc.", "The", "¡Hé!") == ["old mill inc", "the", "hé"]
    assert each(spark, lambda a, b: N.word_bag(a) == N.word_bag(b), ("Kael, Zorwin", "zorwin KAEL"), ("a b", "a b b")) == [True, False]
    assert each(spark, N.maybe_same, ("Best Mill", "The World's Best Mill (2020)"), ("Best Mill (2019)", "Best Mill (2020)"), ("Best Mill", "Best Mill House"), ("", "x")) == [True, False, False, False]
    assert each(spark, N.numbers_differ, ("17 May", "28 May"), ("1,200 in 2020", "1200"), ("none", "5")) == [True, False, False]


def test_stories_and_sentences(spark):
    urls = ["https://www.channelnewsasia.com/a/old-title-5000123?x=1", "HTTPS://WWW.StraitsTimes.com/world/a-b/", "https://zaobao.com.sg/news/story20260102-77/", "https://x.example/p/q/", "no address", None]
    assert each(spark, T.story_key, *urls)[:4] == ["cna:5000123", "st:a-b", "zaobao:story20260102-77", "x.example:/p/q"]
    assert each(spark, T.story_key, *urls)[5] is None
    assert each(spark, T.sentences, "Dr. Kael came. He left! (Why?) 3 asked. No. 5 won", "", None) == [["Dr. Kael came.", "He left!", "(Why?) 3 asked.", "No. 5 won"], [], []]
    six = "A b. C d. E f. G h. I j. K l."
    assert each(spark, T.over_limit, ("A b.", six), (six, six), ("", "A b.")) == [True, False, False]
    df = T.with_title_key(spark.createDataFrame([(1, "Caf&eacute; &amp;  Bar &#8211; X"), (2, " Two  Words "), (3, None)], "i long, t string"), "t", "k")
    assert {r.i: r.k for r in df.collect()} == {1: "café & bar – x", 2: "two words", 3: None}


def test_fields_under_stored_names(spark):
    rows = [(1, "PERSON", {"birth year": "1950", "Occupation": "Baker | Wizard", "Shoe Size": "44"}), (2, "AWARD", {"Awarding entity": "X"}), (3, "PERSON", {"occupation": "Wizard"}), (4, "PERSON", None), (5, "GHOST", {"Name": "n"}), (6, "PERSON", {})]
    allowed = spark.createDataFrame([("Occupation", "Baker")], "field string, term string")
    got = {r.id: (dict(r.kept), list(r.dropped)) for r in FL.clean_fields(spark.createDataFrame(rows, "id long, kind string, fields map<string,string>"), allowed).collect()}
    assert got == {1: ({"Birth Year (yyyy)": "1950", "Occupation": "Baker"}, ["Shoe Size"]), 2: ({"Awarding Entity": "X"}, []), 3: ({}, ["Occupation=Wizard"]), 4: ({}, []), 5: ({}, ["Name"]), 6: ({}, [])}


def test_feeds(spark):
    rss = '<rss version="2.0"><channel><item><title> T &amp; U </title><link>https://a.x/news/1</link><category>P</category><category> Q</category><pubDate>Sat, 07 Mar 2026 09:30:00 +0800</pubDate><description>&lt;p&gt;Hi &lt;b&gt;you&lt;/b&gt;&lt;/p&gt;</description></item><item><guid>https://a.x/other/2</guid><pubDate>soon</pubDate></item><item><title>no address</title></item></channel></rss>'
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><link href=" "/><link href="https://b.x/1"/><updated>2026-03-07T01:30:00Z</updated></entry></feed>'
    docs = [("https://f.x/rss", rss, None), ("https://f.x/kept", rss, "/news/"), ("https://f.x/atom", atom, None), ("https://f.x/odd", "<html/>", None), ("https://f.x/bad", "<rss>", None), ("https://f.x/none", None, None)]
    df = feeds.parse_feeds(spark.createDataFrame(docs, "feed string, xml string, keep string"))
    got = {r.feed[12:]: (r.mode, r.found, r.kept, r.error is None) for r in df.collect()}
    assert got == {"rss": ("rss", 3, 2, True), "kept": ("rss", 3, 1, True), "atom": ("atom", 1, 1, True), "odd": ("unknown", 0, 0, True), "bad": ("broken", 0, 0, False), "none": ("broken", 0, 0, False)}
    a = {(r.feed[12:], r.url): r for r in feeds.feed_articles(df).collect()}
    one = a["rss", "https://a.x/news/1"]
    assert (one.title, one.category, one.description, one.published) == ("T & U", "P, Q", "Hi you", dt.datetime(2026, 3, 7, 1, 30))
    assert (a["rss", "https://a.x/other/2"].title, a["rss", "https://a.x/other/2"].published) == ("https://a.x/other/2", None)
    assert a["atom", "https://b.x/1"].published == dt.datetime(2026, 3, 7, 1, 30)
    assert feeds.read_feed(rss.replace("https://a.x", "https://zaobao.x"), "https://zaobao.x/feed")[4][0][2] == "Hi you"
    assert each(spark, feeds.parse_date, "Sat, 7 Mar 2026 09:30:00 +0800", "7 Mar 2026 01:30:00 GMT", "2026-03-07T01:30:00", "yesterday", None) == [dt.datetime(2026, 3, 7, 1, 30)] * 3 + [None, None]
    held = spark.createDataFrame([("https://a.x/news/1",), ("https://a.x/other/2",)], "url string")
    assert {r.feed[12:]: r.gap for r in feeds.feed_gaps(df, held).collect()} == {"rss": False, "kept": False, "atom": True}


def test_pages(spark):
    html = "<html><nav><p>menu</p></nav><p>One <b>bold</b>&amp; two<p>Three<form><p>form</p></form><script>p('<p>x</p>')</script></p>Read</html>"
    assert each(spark, pages.page_text, html, "", None, "no paragraphs") == ["One bold & two Three", "", None, ""]
    assert each(spark, pages.opening, "short", "Alpha beta. " * 40, "x" * 300, "字" * 150 + "。" + "字" * 200)[0:2] == ["short", ("Alpha beta. " * 40)[:275]]
    assert each(spark, pages.opening, "x" * 300)[0] == "x" * 280 + "…"
    assert each(spark, pages.slug_title, "https://a.x/s/big-news-here/?q=1", "https://a.x/s/a") == ["", "A"]
    assert each(spark, lambda c: pages.index_body(F.split(c, "#")), "H#i#!", "One. # #Two.", None) == ["Hi!", "One.\n\nTwo.", ""]
    assert each(spark, pages.body_error, None, "", "short", "字" * 150, "x" * 399, "x" * 400) == ["missing", "missing", "short", None, "short", None]


def test_parts(spark):
    rows = spark.createDataFrame([(f"u{i % 9}", "ab"[i % 2], i, 30 if i != 5 else 200) for i in range(18)], "url string, source string, n long, size long").withColumn("part_", F.lit(1))
    one = parts.first_of_each(rows, [F.col("n")])
    assert sorted(r.n for r in one.collect()) == list(range(9))
    got = parts.with_parts(one, "source", [F.col("n")], 2).collect()
    assert sorted((r.source, r.part, r["at"], r.n) for r in got) == [("a", 1, 0, 0), ("a", 1, 1, 2), ("a", 2, 0, 4), ("a", 2, 1, 6), ("a", 3, 0, 8), ("b", 1, 0, 1), ("b", 1, 1, 3), ("b", 2, 0, 5), ("b", 2, 1, 7)]
    p = parts.byte_parts(rows, "size", [F.col("n")], 100).groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("s")).collect()
    assert sum(r.n for r in p) == 18 and all(r.s <= 100 or r.n == 1 for r in p) and sorted(r.part for r in p) == list(range(1, len(p) + 1))
    assert parts.with_parts(one.limit(0), "source", [F.col("n")]).count() == 0


def test_answers(spark):
    chat = ['Sure:\n```json\n{"a": "one\ntwo", "b": {"c": "}\\"{"}}\n``` {x}', '{"a": "甲\n乙"}', '{"a": "cut', "no object", "", None]
    assert each(spark, answers.json_object, *chat) == ['{"a": "one two", "b": {"c": "}\\"{"}}', '{"a": "甲乙"}', None, None, None, None]
    ok = '[{"summary": "s", "evidence": "e"}]'
    assert each(spark, answers.answer_fault, ok, f"```json\n{ok}\n```", '{"entities": [{"summary": "s"}]}', '{"x": 1}', "[1", "I see", " ", None) == ["", "", "lacks summary or evidence", "no entities", "cut off", "prose", "empty", "empty"]
    said = each(spark, answers.split_fields, "Founder: Ana · Bo · Description: d: e", "loose", None)
    assert [[(p.key, p.value) for p in x] for x in said] == [[("Founder", "Ana · Bo"), ("Description", "d: e")], [("", "loose")], []]
    assert each(spark, answers.one_line, "\n  “Good day”  \nmore", "x" * 141, None) == ["Good day", "", ""]
    m = spark.createDataFrame([(1, 7, "Ana", None), (2, 7, "海", "Ana"), (3, 7, "Bo", "Bob"), (4, 8, "Ana", None)], "id long, article_id long, entity_name string, entity_name_en string")
    a = [(7, "Ana", 1, "MATCH", "u1", ["u1"]), (7, "Ana", 2, "MATCH", "u2", ["u2"]), (7, "Bob", 3, "MATCH", "u9", ["u1"]), (7, "Bob", 4, "FLAG", None, []), (7, "Ghost", 5, "MATCH", "u1", ["u1"])]
    got = answers.first_answers(spark.createDataFrame(a, "article_id long, name string, at int, action string, uid string, offered array<string>"), m)
    assert {tuple(r) for r in got.collect()} == {(1, "MATCH", "u1"), (2, "CREATE_NEW", None), (3, "FLAG", None), (4, "CREATE_NEW", None)}


def test_rewrites(spark):
    old = "Kael founded the mill in 1950. He died there."
    assert edits.judged(old, old + " It reopened as a museum last spring.")[0] == "keep"
    assert edits.judged(old, "Kael founded a mill in 1950. He died there.")[0] == "drop"
    assert edits.judged(old, "A museum of weaving stands in the harbour today.")[0] == "flag"
    assert edits.judged(None, " New. ") == ("keep", 1.0, ["New."], [("in", "New.")]) and edits.judged("x", None)[0] == "drop"
    assert [k for k, _ in edits.pieces("a b c", "a x c d")] == ["same", "out", "in", "same", "in"]
    got = edits.edits(["Kael founded the mill.", "He died."], ["Kael founded the mill in 1950.", "He died.", "A museum opened on the site."])
    assert got == [(0, 1, "Kael founded the mill in 1950."), (2, 2, "A museum opened on the site.")]
    df = spark.createDataFrame([(old, None), (None, None), (old, old + " It reopened in 2001.")], "o string, n string")
    assert [r.v for r in df.select(edits.change(F.col("o"), F.col("n")).getField("verdict").alias("v")).collect()] == ["drop", "keep", "keep"]
    assert [len(r.e) for r in df.select(edits.sentence_edits(F.col("o"), F.col("n")).alias("e")).collect()] == [0, 0, 1]


def test_reach(spark):
    assert [sorted(x) for x in each(spark, reach.forms, "Kael, Zorwin (poet)", "Singapore. Mill Board", "海城 电影会", "Mill", "A. B.", None and "x")[:5]] == [["kael zorwin", "zorwin kael"], ["mill board", "singapore mill board"], ["海城电影会"], [], []]
    day = lambda n: dt.date(2026, 1, n)
    arts = spark.createDataFrame([(1, day(5), "Zorwin Kael, poet"), (2, day(3), "the Zorwin Kaels"), (3, day(4), "kael ZORWIN won"), (4, day(9), "看海城电影会"), (5, None, "Zorwin Kael")], "id long, day date, text string")
    names = spark.createDataFrame([("p", "Kael, Zorwin", day(1), day(30)), ("q", "Kael, Zorwin", day(5), day(30)), ("f", "海城电影会", day(1), day(30)), ("n", "Nobody Here", day(1), day(30)), ("l", "Kael, Zorwin", day(10), day(30))], "key string, name string, start date, stop date")
    assert {(r.key, r.id) for r in reach.first_printed(names, arts).collect()} == {("p", 3), ("q", 1), ("f", 4)}
    assert {r.id for r in reach.names_any(spark.createDataFrame([(1, "At THE MILL BOARD today"), (2, "mill"), (3, None)], "id long, text string"), spark.createDataFrame([("Mill Board",), ("mill",)], "name string")).collect()} == {1}
    assert each(spark, reach.sentences_with, ("A Kael. No. See Kael? Kael!", "Kael"), ("看见甲。没有。甲在！", "甲")) == [["A Kael.", "See Kael?"], ["看见甲。", "甲在！"]]
    assert each(spark, reach.ages_near, ("Zorwin Kael, aged 54, and Bo, 33-year-old", "Zorwin Kael"), ("aged 54 said Kael", "Kael")) == [[54], []]
    assert each(spark, reach.fact_norm, "Singapore. Ministry of Mills (MoM)", "Prizes (2016)", "glass") == ["ministry of mill", "prize 2016", "glass"]


def test_cards(spark):
    m = spark.createDataFrame([(1, 10, "u1"), (2, 11, None), (3, 12, ""), (1, 10, "u1"), (4, 99, "u1")], "id long, extracted_id long, matched_uid string")
    e = spark.createDataFrame([(10, 5, "PERSON", "Kael", None), (11, 5, "PERSON", "海", "The Mill-Man"), (12, 6, "PERSON", "Mill Man", None)], "id long, article_id long, entity_type string, entity_name string, entity_name_en string")
    a = spark.createDataFrame([(5, "https://zaobao.x/1", dt.datetime(2026, 1, 2))], "id long, url string, pubdate timestamp")
    deck = C.cards(C.proposals(m, e, a))
    got = {r.card: (r.entity, list(r.pids), list(r.langs), r.newest, r.fresh) for r in deck.collect()}
    assert got == {"uid:u1": ("Kael", [1], ["zh"], "2026-01-02", False), "new:PERSON:mill man": ("Mill Man", [2, 3], ["en", "zh"], "2026-01-02", True)}
    rev = spark.createDataFrame([(1, 7, "approve", []), (2, 7, "unsure", [7]), (3, 8, "reject", [])], "pid long, reviewer long, verdict string, kept_by array<bigint>")
    assert {r.card: r.settled for r in C.settled(deck, rev).collect()} == {"uid:u1": True, "new:PERSON:mill man": False}
    assert [r.card for r in C.open_for(deck, rev, F.lit(7)).collect()] == [] and [r.card for r in C.open_for(deck, rev, F.lit(9)).collect()] == ["new:PERSON:mill man"]
    recs = spark.createDataFrame([("1", "P", "Singapore. Mill Board", None, True), ("2", "P", "磨坊", "1", True), ("3", "P", "Harbour Guild", None, True), ("4", "P", "Lost", None, False)], "uid string, kind string, name string, canonical_uid string, is_active boolean")
    asked = spark.createDataFrame([("P", n) for n in ("mill board", "磨坊", "Harbour Gild", "Lost", "harbour guild")], "kind string, name string")
    got = {r.name: (r.uid, r.as_, r.nearest) for r in C.find_records(asked, recs).collect()}
    assert got == {"mill board": ("1", "Singapore. Mill Board", None), "磨坊": ("1", "Singapore. Mill Board", None), "Harbour Gild": (None, None, "Harbour Guild"), "Lost": (None, None, None), "harbour guild": ("3", None, None)}
    news = spark.createDataFrame([("c", "u", "Awards", "Star | Moon"), ("c", "u", "Street Address", "Mill Lane"), ("c", "u", "Description", "New."), ("c", "u", "Title", "Dr"), ("c", "u", "Name", "x"), ("c", "u", "Country", " ")], "card string, uid string, field string, value string")
    held = spark.createDataFrame([("u", {"Awards": "The Star", "Street Address": "5 Mill Lane", "Description": "Old."})], "uid string, fields map<string,string>")
    assert {r.field: (r.state, r.fresh) for r in C.delta(news, held).collect()} == {"Awards": ("extra", "Moon"), "Street Address": ("same", ""), "Description": ("differs", "New."), "Title": ("new", "Dr")}


def test_dealing(spark):
    at = lambda m: dt.datetime(2026, 1, 1) + dt.timedelta(minutes=m)
    cards = spark.createDataFrame([("d", 0, "A", [1, 2]), ("d", 1, "B", [3]), ("e", 0, "Z", [9])], "desk string, ord int, card string, pids array<bigint>")
    log = [
        (1, 0, 5, "take", None, None, None), (2, 1, 6, "take", None, None, None), (3, 2, 7, "take", None, None, None), (4, 3, 6, "decide", "A", 1, "approve"), (5, 4, 5, "decide", "A", 1, "unsure"),
        (6, 5, 5, "take", None, None, None), (7, 6, 8, "claim", "B", None, None), (8, 70, 8, "claim", "B", None, None), (9, 71, 6, "renew", "B", None, None), (10, 72, 8, "decide", "B", 3, "approve"),
        (11, 73, 8, "done", None, 3, None), (12, 74, 9, "claim", "B", None, None), (13, 75, 9, "take", None, None, None), (14, 76, 9, "decide", "A", 1, "reject"), (15, 77, 9, "decide", "A", 2, "perhaps"), (16, 78, 3, "release", "A", None, None),
    ]
    cmds = spark.createDataFrame([("d", s, at(t), w, v, c, p, x) for s, t, w, v, c, p, x in log], "desk string, seq long, ts timestamp, who long, verb string, card string, pid long, verdict string")
    got = {r.seq: (r.card, r.done) for r in dealing.replay_desks(cards, cmds).collect()}
    # two cards go to two reviewers and none is left; a third decides nothing; 5's unsure leaves A open to 5 only for its other proposal
    assert [got[i] for i in range(1, 7)] == [("A", True), ("B", True), (None, False), ("A", False), ("A", True), ("A", True)]
    # B is held live until its hour is over, then 8 has it, 6 has lost it, and what is decided stays
    assert [got[i][1] for i in range(7, 13)] == [False, True, False, True, True, False]
    # 5's hold of A ended: 9 takes it over and overrules the unsure; a decision gives the card back
    assert [got[i] for i in (13, 14, 15, 16)] == [("A", True), ("A", True), ("A", False), ("A", False)]
    items = spark.createDataFrame([("t", i, f"i{i}") for i in (1, 2, 3)], "task string, ord int, item string")
    log = [(1, 0, "x", "take"), (2, 1, "y", "take"), (3, 2, "x", "save"), (4, 3, "x", "take"), (5, 4, "y", "take"), (6, 5, "y", "save"), (7, 6, "y", "take"), (8, 7, "z", "take"), (9, 8, "x", "save"), (10, 9, "x", "release")]
    cmds = spark.createDataFrame([("t", s, at(t), w, v, None) for s, t, w, v in log], "task string, seq long, ts timestamp, labeller string, verb string, item string")
    got = {r.seq: (r.item, r.done) for r in dealing.replay_labelling(items, cmds, 1).collect()}
    # the first is everybody's; of the others each goes to one
    assert got == {1: ("i1", True), 2: ("i1", True), 3: ("i1", True), 4: ("i2", True), 5: ("i1", True), 6: ("i1", True), 7: ("i3", True), 8: ("i1", True), 9: ("i2", True), 10: (None, False)}


def test_ingest_goes_on_where_it_stopped(spark, tmp_path):
    from authlens.streaming.ingest import ingest_once

    t = lambda d: dt.datetime(2026, 1, d)
    schema = "id long, url string, created_at timestamp"
    src, place = str(tmp_path / "in"), str(tmp_path / "place")
    spark.createDataFrame([(1, "a", t(1)), (2, "a", t(2)), (3, None, t(1)), (4, "b", None)], schema).coalesce(1).write.parquet(src)
    assert {r.id for r in ingest_once(spark, src, place).collect()} == {1, 4}
    spark.createDataFrame([(5, "a", t(30)), (6, "c", t(1))], schema).coalesce(1).write.mode("append").parquet(src)
    # a month late and seen before: not taken again; nothing new: nothing changes
    assert {r.id for r in ingest_once(spark, src, place).collect()} == {1, 4, 6}
    assert {r.id for r in ingest_once(spark, src, place).collect()} == {1, 4, 6}


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from authlens.scratch import shared_folder

    conf = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077", applicationId="x"), conf=conf)
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(cluster)


def test_exports_and_archives(spark, tmp_path):
    import io
    import zipfile

    from authlens.sources import exports

    head = "Key UID,Key Descriptor,Key Vocabulary,Relationship Type,Related UID,Related Descriptor,Related Vocabulary\n"
    body = head + '1,"Mill, Old",_Organisations,Awards,,"Say ""hi"", all",\n1,"Mill, Old",_Organisations,Use,2,Guild,_Organisations\n'
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "TTE-ORGANISATIONS_FULL_20260603.csv").write_text("﻿" + body, encoding="utf-8")
    (tmp_path / "csv" / "TTE-GHOSTS_FULL_20260603.csv").write_text(body, encoding="utf-8")
    rows = exports.read_exports(spark, str(tmp_path / "csv")).orderBy("pos").collect()
    assert [(r.entity_type, str(r.snapshot), r.key_uid, r.key_descriptor, r.related_uid, r.related_descriptor) for r in rows] == [
        ("ORGANISATION", "2026-06-03", "1", "Mill, Old", None, 'Say "hi", all'), ("ORGANISATION", "2026-06-03", "1", "Mill, Old", "2", "Guild"),
    ]
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("a/TTE-PEOPLE_FULL_20260603.csv", body)
        z.writestr("deletes.csv", 'uid,why\n"7",x\n8,y\n')
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("in.zip", inner.getvalue())
        z.writestr("readme.txt", "x")
        z.writestr("TTE-GHOSTS_FULL_20260603.csv", body)
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    got = exports.expand_archives(spark, str(tmp_path))
    assert {(r.archive, r.filename, r.kind, r.content is not None) for r in got.collect()} == {
        ("d.zip", "TTE-PEOPLE_FULL_20260603.csv", "export", True), ("d.zip", "deletes.csv", "deletes", True), ("d.zip", "readme.txt", "skipped", False), ("d.zip", "TTE-GHOSTS_FULL_20260603.csv", "skipped", False), ("bad.zip", "bad.zip", "skipped", False),
    }
    assert {r.uid for r in exports.delete_list(got).collect()} == {"7", "8"}


def test_linked_values_search_for_no_nearest_names(spark, monkeypatch):
    def search(*_):
        raise AssertionError("a search by trigrams of which nothing is used")

    monkeypatch.setattr(C, "top_candidates", search)
    recs = spark.createDataFrame([("1", "AWARD", "Singapore. Mill Medal", None, True), ("2", "AWARD", "Tide Prize", None, True)], "uid string, kind string, name string, canonical_uid string, is_active boolean")
    rows = spark.createDataFrame([("a", "Awards", "mill medal (1999) | Tide Prise | tide prize"), ("a", "Title", "Dr")], "id string, field string, value string")
    assert [(r.id, r.field, r.value) for r in C.linked_values(rows, recs).collect()] == [("a", "Awards", "Singapore. Mill Medal (1999) | Tide Prise | Tide Prize")]


def test_labelling_pile_passes_over_nothing_twice():
    """20,000 items beyond the shared ones; a hold that ran out, one given back and one that was labelled out of turn."""
    import time

    at = lambda m: dt.datetime(2026, 1, 1) + dt.timedelta(minutes=m)
    pile, began = dealing.Pile(1), time.thread_time()
    for i in range(1, 20_001):
        pile.add(f"i{i}", i)
    assert [pile.take(w, at(0)) for w in "xy"] == ["i1", "i1"] and pile.save("i1", "x", at(0)) and pile.save("i1", "y", at(0))
    assert [pile.take(w, at(1)) for w in "xy"] == ["i2", "i3"] and pile.save("i4", "y", at(2)) and not pile.save("i2", "y", at(2))
    # y's own hold ends with the next take, i4 is labelled; after an hour x's i2 is anybody's, and x still gives back what nobody took
    assert pile.take("y", at(3)) == "i3" and pile.give_back("y") and not pile.give_back("y")
    assert pile.take("y", at(61)) == "i2" and not pile.give_back("x") and pile.take("x", at(62)) == "i3"
    for i in range(5, 20_001):
        assert pile.save(pile.last["x"], "x", at(63)) and pile.take("x", at(63)) == f"i{i}"
    assert time.thread_time() - began < 20
