"""Queries that compose the operators: exports and imports of the stages, publishing, sheets, messages and checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import text as T
from ..operators import cards as C
from ..operators import components
from ..sources import pages, parts
from . import _sql as S
from . import desk, table
from .desk import _PROPS, _REVIEWS, _UPS
from .reference import _STORY, _TWICE, _VOTES, _twice, _votes
from .reference import query as _query

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    return _query(sql, QUERIES, SQL)


@query("select article_id, to_json(list({'id': id, 'name': coalesce(entity_name, ''), 'type': coalesce(entity_type, '')} order by id)) as payload from (select distinct id, article_id, entity_name, entity_type from extracted_entities where not resolved and article_id is not null) group by article_id")
def mentions_to_resolve(spark, d):
    """One row an article that waits, its mentions as JSON."""
    e = table(spark, d, "extracted_entities").filter("not resolved and article_id is not null").select("id", "article_id", F.coalesce("entity_name", F.lit("")).alias("name"), F.coalesce("entity_type", F.lit("")).alias("type")).distinct()
    return e.groupBy("article_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("id", "name", "type")))).alias("payload"))


@query(f"""with {_PROPS}, {_REVIEWS}, was as (select distinct card from props where pid % 3 <> 0), now_ as (select distinct card from props where pid % 4 <> 0), rv as (select distinct card from props where pid in (select pid from rev))
select card, case when w.card is null then 'insert' when n.card is not null then 'update' when card in (select card from rv) then 'keep' else 'delete' end as action from was w full join now_ n using (card)""")
def deck_publication(spark, d):
    """A deck over the one before: cards built are written, cards no longer built go unless they were reviewed."""
    p = desk._props(spark, d)
    was, now = p.filter("pid % 3 <> 0").select("card").distinct().withColumn("_w", F.lit(1)), p.filter("pid % 4 <> 0").select("card").distinct().withColumn("_n", F.lit(1))
    rv = p.join(desk._reviews(spark, d).select("pid"), "pid", "left_semi").select("card").distinct().withColumn("_r", F.lit(1))
    x = was.join(now, "card", "full").join(rv, "card", "left")
    return x.select("card", F.when(F.col("_w").isNull(), "insert").when(F.col("_n").isNotNull(), "update").when(F.col("_r").isNotNull(), "keep").otherwise("delete").alias("action"))


@query("select id, coalesce(confidence, '') as confidence, resolution_action as action from (select distinct id, confidence, resolution_action from candidate_matches)")
def status_steps(spark, d):
    """``step=outcome`` pairs read to a map."""
    s = table(spark, d, "candidate_matches").select("id", F.concat(F.lit("match="), "resolution_action", F.lit(",sure="), F.coalesce("confidence", F.lit(""))).alias("steps")).distinct()
    m = s.select("id", F.str_to_map("steps", F.lit(","), F.lit("=")).alias("m"))
    return m.select("id", F.col("m")["sure"].alias("confidence"), F.col("m")["match"].alias("action"))


@query("select url, strftime(arg_max(pubdate, (created_at, id)), '%Y-%m-%d') as published from articles where url is not null and pubdate is not null and created_at is not null group by url")
def dates_of_addresses(spark, d):
    a = table(spark, d, "articles").filter("url is not null and pubdate is not null and created_at is not null").select("url", "pubdate", "created_at", "id")
    return parts.last_line(a, "url", ["created_at", "id"]).select("url", F.date_format("pubdate", "yyyy-MM-dd").alias("published"))


@query("select id, entity_name as name from extracted_entities where id % 7 <> 0 and entity_name is not null")
def lines_not_cut(spark, d):
    """JSON lines of which every seventh lost its end; what cannot be read is left out."""
    e = table(spark, d, "extracted_entities").filter("entity_name is not null")
    line = F.to_json(F.struct("id", F.col("entity_name").alias("name")))
    x = e.select(F.when(F.col("id") % 7 == 0, F.expr("substring(to_json(struct(id, entity_name)), 1, 9)")).otherwise(line).alias("line"))
    x = x.select(F.from_json("line", "id long, name string, _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return x.filter("r._bad is null and r.id is not null").select("r.id", "r.name")


@query("select distinct c.id from candidate_matches c join extracted_entities e on e.id = c.extracted_id where not e.resolved")
def still_waiting(spark, d):
    return table(spark, d, "candidate_matches").join(table(spark, d, "extracted_entities").filter("not resolved").select(F.col("id").alias("extracted_id")), "extracted_id", "left_semi").select("id").distinct()


@query(f"""with {_PROPS}, {_REVIEWS}, p as (select distinct r.reviewer, r.pid, r.verdict, p.card, d.grp from rev r join props p using (pid) join deck d on d.card = p.card)
select reviewer, grp, count(distinct card) as cards, count(distinct case when verdict = 'approve' then pid end) as to_apply, count(distinct case when verdict = 'unsure' then pid end) as unsure from p group by all having count(distinct case when verdict <> 'reject' then pid end) > 0""")
def reviewer_messages(spark, d):
    p = desk._props(spark, d)
    deck = C.cards(p).select("card", "grp")
    x = desk._reviews(spark, d).join(p.select("pid", "card").distinct(), "pid").join(deck, "card")
    of = lambda v: F.countDistinct(F.when(F.col("verdict") == v, F.col("pid")))
    return x.groupBy("reviewer", "grp").agg(F.countDistinct("card").alias("cards"), of("approve").alias("to_apply"), of("unsure").alias("unsure")).filter("to_apply + unsure > 0")


@query(f"with {_VOTES}, f as (select labeller, min(task) as task, count(*) as n from usable group by labeller) select task, string_agg(labeller || '=' || n, ' ' order by n desc, labeller) as labellers from f group by task")
def labellers_listed(spark, d):
    f = _votes(spark, d).groupBy("labeller").agg(F.min("task").alias("task"), F.count("*").alias("n"))
    one = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "labeller", "n"))), lambda s: F.concat(s["labeller"], F.lit("="), s["n"].cast("string")))
    return f.groupBy("task").agg(F.array_join(one, " ").alias("labellers"))


@query(f"""with {_STORY}, k as (select key, min(c.id) as id, min(title) filter (title <> '') as title, strftime(min(ts), '%Y-%m-%d') as day from c where key is not null and id % 2 = 1 group by key) select * from k where key not in (select key from c where id % 2 = 0 and key is not null)""")
def stories_missed(spark, d):
    """Of an archive (odd ids) the stories not held (even ids), with what any of their articles says."""
    a = table(spark, d, "articles").groupBy("id").agg(F.min("url").alias("url"), F.min("title").alias("title"), F.min(F.coalesce("pubdate", "created_at")).alias("ts")).withColumn("key", T.story_key(F.col("url"))).filter("key is not null")
    k = a.filter("id % 2 = 1").groupBy("key").agg(F.min("id").alias("id"), F.min(F.nullif("title", F.lit(""))).alias("title"), F.date_format(F.min("ts"), "yyyy-MM-dd").alias("day"))
    return parts.not_held(k, a.filter("id % 2 = 0"), "key")


@query(f"""with recursive {_TWICE}, w as (select id, bool_or(coalesce(relevant, false)) as worked, min(url) as url, min(title) as title, min(coalesce(pubdate, created_at)) as ts from twice group by id), n as (select *, row_number() over (order by not worked, id) as rank from w),
c as (select rank, id, ts, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\\.', '') as outlet, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\\.', '') || ':' || rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') as key, {S.tight(S.low('title'))} as t from n),
used as (select outlet, t from c where t <> '' group by all having count(distinct coalesce(ts::date, '0001-01-01'::date)) < 3),
close as (select x.rank, min(y.rank) as to_ from c x join used using (outlet, t) join c y on y.outlet = x.outlet and y.t = x.t and y.rank < x.rank and abs(epoch_us(x.ts) - epoch_us(y.ts)) <= 2 * 86400000000 where x.t <> '' group by all),
keyed as (select rank, min(rank) over (partition by key) as to_ from c where key is not null), ptr as (select c.rank, case when k.to_ < c.rank then k.to_ else n.to_ end as to_ from c left join keyed k on k.rank = c.rank left join close n on n.rank = c.rank),
walk as (select rank, rank as seen from c union all select w.rank, p.to_ from walk w join ptr p on p.rank = w.seen where p.to_ is not null), root as (select rank, min(seen) as first from walk group by rank)
select a.id as copy, b.id as first from root r join c a on a.rank = r.rank join c b on b.rank = r.first where r.rank <> r.first""")
def duplicates_to_mark(spark, d):
    """Copies among what is stored, the most-worked article of a story kept: the articles in that order take its places as ids."""
    a = _twice(spark, d).groupBy("id").agg(F.max(F.coalesce("relevant", F.lit(False))).alias("worked"), F.min("url").alias("url"), F.min("title").alias("title"), F.min(F.coalesce("pubdate", "created_at")).alias("ts"))
    n = C.ordered_positions(a, [F.col("worked").desc(), F.col("id")], "rank")
    roots = components.story_copies(n.select(F.col("rank").alias("id"), "url", "title", F.col("ts").alias("pubdate"), F.col("ts").alias("created_at"))).filter("id <> original")
    at = n.select("rank", F.col("id").alias("_id"))
    return roots.join(at, roots["id"] == at["rank"]).select(F.col("_id").alias("copy"), "original").join(at.select(F.col("rank").alias("original"), F.col("_id").alias("first")), "original").select("copy", "first")


@query(f"with {_UPS}, n as (select card, list_sort(list(distinct pid)) as pids, count(distinct link) as links from ups where link is not null group by card) select card, card || '|' || array_to_string(pids, ',') as key from n where links >= 2")
def draft_keys(spark, d):
    """Cards that two articles or more say something of, under a key that changes with the proposals."""
    u = desk._ups(spark, d).filter("link is not null")
    n = u.groupBy("card").agg(F.array_sort(F.collect_set("pid")).alias("pids"), F.countDistinct("link").alias("links")).filter("links >= 2")
    return n.select("card", F.concat("card", F.lit("|"), F.array_join("pids", ",")).alias("key"))


_NUMS = lambda c: f"list_distinct(list_transform(regexp_extract_all({c}, '[0-9][0-9,.]*[0-9]|[0-9]'), lambda x: replace(x, ',', '')))"


@query(f"""with s as (select id, article_id, entity_name as name, summary || ' In 1999.' as said, coalesce(evidence, '') || ' ' || year(created_at) as material from extracted_entities where summary is not null and created_at is not null),
x as (select distinct id, len(list_filter({_NUMS('said')}, lambda v: not list_contains({_NUMS('material')}, v))) = 0 as numbers_given, coalesce(contains(lower(said), lower(name)), false) as named, len(list_filter({S.content('said')}, lambda v: not list_contains({S.content('material')}, v))) as new_words from s) select * from x""")
def sentences_checked(spark, d):
    """Generated sentences against their source: every number must be the source's, the record must be named, and how many words are new."""
    e = table(spark, d, "extracted_entities").filter("summary is not null and created_at is not null")
    said, material = F.concat("summary", F.lit(" In 1999.")), F.concat(F.coalesce("evidence", F.lit("")), F.lit(" "), F.year("created_at").cast("string"))
    given = F.size(F.array_except(N.numbers(said), N.numbers(material))) == 0
    new = F.size(F.array_except(N.content_words(said), N.content_words(material))).cast("long")
    return e.select("id", given.alias("numbers_given"), F.coalesce(F.lower(said).contains(F.lower("entity_name")), F.lit(False)).alias("named"), new.alias("new_words")).distinct()


@query(f"""with {_UPS}, {_REVIEWS}, r as (select distinct coalesce(u.uid, u.card) as record, u.field, v as value, min(u.pid) over (partition by coalesce(u.uid, u.card), u.field, v) as pid from (select *, unnest({S.parts('value')}) as v from ups) u where u.pid in (select pid from rev where verdict = 'approve'))
select record, field, value, pid from r""")
def approved_changes(spark, d):
    """One row a change that was approved, once a record, field and value, under its first proposal."""
    ok = desk._reviews(spark, d).filter("verdict = 'approve'").select("pid")
    u = desk._ups(spark, d).join(ok, "pid", "left_semi").select(F.coalesce("uid", "card").alias("record"), "field", "pid", F.explode(N.values(F.col("value"))).alias("value"))
    return u.groupBy("record", "field", "value").agg(F.min("pid").alias("pid"))


@query("with c as (select distinct id, resolution_action, matched_uid, field_updates from candidate_matches), u as (select id, resolution_action, matched_uid, unnest(case when field_updates is null or len(field_updates) = 0 then [null] else field_updates end) as u from c) select distinct id, resolution_action as action, u.field as field, u.value as value, case when resolution_action like 'FLAG%' then 0 else 1 end as turn from u")
def review_sheet(spark, d):
    """A row a proposed change; a decision without one keeps its row, flags first."""
    c = table(spark, d, "candidate_matches").select("id", "resolution_action", F.explode_outer("field_updates").alias("u"))
    return c.select("id", F.col("resolution_action").alias("action"), "u.field", "u.value", F.when(F.col("resolution_action").startswith("FLAG"), 0).otherwise(1).alias("turn")).distinct()


@query("with a as (select id, min(url) as url, min(description) as description from articles group by id), r as (select article_id, max(evidence) as again from extracted_entities where evidence is not null and article_id is not null group by all) select a.id, coalesce(r.again, a.description) as description from a left join r on r.article_id = a.id where a.description like 'Earlier%'")
def descriptions_repaired(spark, d):
    """Descriptions that begin with a mark of failure, replaced where a second reading has one."""
    a = table(spark, d, "articles").groupBy("id").agg(F.min("description").alias("description")).filter(F.col("description").startswith("Earlier"))
    r = table(spark, d, "extracted_entities").filter("evidence is not null and article_id is not null").groupBy(F.col("article_id").alias("id")).agg(F.max("evidence").alias("again"))
    return a.join(r, "id", "left").select("id", F.coalesce("again", "description").alias("description"))


@query("with b as (select article_id as id, max(text) as body from documents where article_id is not null group by all) select a.id, length(coalesce(b.body, ''))::int as body, case when b.id is null then 'not fetched' else '' end as error from (select distinct id from articles) a left join b on b.id = a.id")
def bodies_filled(spark, d):
    rows = table(spark, d, "articles").select(F.col("id").alias("url")).distinct()
    got = table(spark, d, "documents").filter("article_id is not null").select(F.col("article_id").alias("url"), F.col("text").alias("body"), F.lit("").alias("error"))
    x = pages.filled(rows, got).join(got.select("url").distinct().withColumn("_got", F.lit(True)), "url", "left")
    return x.select(F.col("url").alias("id"), F.length("body").alias("body"), F.when(F.col("_got").isNull(), "not fetched").otherwise("").alias("error"))


@query("with e as (select article_id, entity_name as name, min(id) as first from extracted_entities where article_id is not null and entity_name is not null group by all), a as (select article_id, string_agg(name, ' | ' order by first, name) as names, min(first) as first from e group by article_id) select article_id, names, row_number() over (order by first, article_id) - 1 as ord from a")
def extraction_items(spark, d):
    """One item an article, its names once each as first seen."""
    e = table(spark, d, "extracted_entities").filter("article_id is not null and entity_name is not null").groupBy("article_id", F.col("entity_name").alias("name")).agg(F.min("id").alias("first"))
    a = e.groupBy("article_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "name"))), lambda s: s["name"]), " | ").alias("names"), F.min("first").alias("first"))
    return C.ordered_positions(a, [F.col("first"), F.col("article_id")]).select("article_id", "names", "ord")


@query(f"with {_VOTES} select labeller, count(*) filter (task = 'relevance') as relevance, count(*) filter (task = 'matching') as matching, count(*) filter (task = 'extraction') as extraction from usable where labeller not like 'a%' group by labeller")
def labels_returned(spark, d):
    """What each labeller gave to each sheet, test accounts (here those beginning with a) left out."""
    tasks = ["relevance", "matching", "extraction"]
    v = _votes(spark, d).filter(~F.col("labeller").startswith("a"))
    return v.groupBy("labeller").pivot("task", tasks).agg(F.count(F.lit(1))).select("labeller", *[F.coalesce(t, F.lit(0)).alias(t) for t in tasks])


@query(f"with {_PROPS}, m as (select distinct p.extracted_id, p.uid, p.day from props p where p.uid is not null and p.day is not null), f as (select id, unnest(map_entries(fields)) as e from extracted_entities) select m.extracted_id, m.uid, m.day, f.e.key as field, f.e.value as value from m join f on f.id = m.extracted_id where f.e.value is not null and f.e.key in ('Occupation', 'Affiliations(groupName)', 'Awards', 'Country')")
def facts_of_matches(spark, d):
    m = desk._props(spark, d).filter("uid is not null and day is not null").select("extracted_id", "uid", "day").distinct()
    f = table(spark, d, "extracted_entities").select(F.col("id").alias("extracted_id"), F.explode(F.map_filter("fields", lambda k, v: k.isin("Occupation", "Affiliations(groupName)", "Awards", "Country") & v.isNotNull())).alias("field", "value"))
    return m.join(f, "extracted_id")


@query(f"""with o as (select {S.plain('name')} as k, min(uid) as org from entities where entity_type = 'ORGANISATION' and is_active and name is not null group by 1), a as (select uid, p[i] as v, i from (select uid, {S.parts("fields['Affiliations(groupName)']")} as p, unnest(generate_series(1, len({S.parts("fields['Affiliations(groupName)']")}))) as i from entities))
select a.uid, arg_min(o.org, i) as org from a join o on o.k = {S.plain('a.v')} group by a.uid""")
def first_known_parent(spark, d):
    e = table(spark, d, "entities")
    o = e.filter("entity_type = 'ORGANISATION' and is_active and name is not null").groupBy(N.plain(F.col("name")).alias("k")).agg(F.min("uid").alias("org"))
    a = e.select("uid", F.posexplode(N.values(F.try_element_at("fields", F.lit("Affiliations(groupName)")))).alias("i", "v")).withColumn("k", N.plain(F.col("v")))
    return a.join(o, "k").groupBy("uid").agg(F.min_by("org", "i").alias("org"))


@query("select distinct matched_uid as uid, nullif(e.canonical_uid, e.uid) as pointer from candidate_matches c join entities e on e.uid = c.matched_uid")
def referenced_records(spark, d):
    m = table(spark, d, "candidate_matches").filter("matched_uid is not null").select(F.col("matched_uid").alias("uid")).distinct()
    return m.join(table(spark, d, "entities").select("uid", F.nullif("canonical_uid", F.col("uid")).alias("pointer")), "uid")


@query("with u as (select c.id, e.fields, c.field_updates from (select distinct on (id) id, extracted_id, field_updates from candidate_matches order by id) c join extracted_entities e on e.id = c.extracted_id), k as (select id, unnest(list_distinct(list_concat(list_filter(map_keys(fields), lambda x: x in ('Country', 'Occupation', 'Description')), ['status']))) as k, fields from u) select id, string_agg(k || '=' || case when k = 'status' then 'new' else coalesce(fields[k], '') end, ';' order by k) as doc from k group by id")
def documents_carried(spark, d):
    """A new document that keeps three keys of the one before it."""
    e = table(spark, d, "extracted_entities").select(F.col("id").alias("extracted_id"), "fields")
    c = table(spark, d, "candidate_matches").groupBy("id").agg(F.min("extracted_id").alias("extracted_id")).join(e, "extracted_id")
    kept = F.map_filter(F.coalesce("fields", F.create_map().cast("map<string,string>")), lambda k, v: k.isin("Country", "Occupation", "Description"))
    doc = F.map_concat(kept, F.create_map(F.lit("status"), F.lit("new")))
    return c.select("id", F.array_join(F.transform(F.array_sort(F.map_entries(doc)), lambda x: F.concat(x["key"], F.lit("="), F.coalesce(x["value"], F.lit("")))), ";").alias("doc"))


@query("select id, resolution_action in ('MATCH_AND_UPDATE', 'FLAG_DB_DUPLICATE') = (matched_uid is not null) as target_as_expected, coalesce(len(candidates), 0) > 0 as had_choice, coalesce(list_contains([c.uid for c in candidates], matched_uid), matched_uid is null) as offered from (select distinct id, resolution_action, matched_uid, candidates from candidate_matches)")
def decisions_expected(spark, d):
    c = table(spark, d, "candidate_matches").select("id", "resolution_action", "matched_uid", "candidates").distinct()
    offered = F.array_contains(F.transform("candidates", lambda x: x["uid"]), F.col("matched_uid"))
    return c.select("id", (F.col("resolution_action").isin("MATCH_AND_UPDATE", "FLAG_DB_DUPLICATE") == F.col("matched_uid").isNotNull()).alias("target_as_expected"), (F.coalesce(F.size("candidates"), F.lit(0)) > 0).alias("had_choice"), F.coalesce(offered, F.col("matched_uid").isNull()).alias("offered"))


@query("with e as (select event_id % 900 as pid, event_type, ts, event_id from events where event_type in ('purchase', 'signup')), x as (select pid, arg_min(event_type, (ts, event_id)) as a, arg_max(event_type, (ts, event_id)) as b, count(*) as n from e group by pid) select a = b as agree, count(*) as proposals from x where n > 1 group by all")
def deciders_agree(spark, d):
    e = table(spark, d, "events").filter("event_type in ('purchase', 'signup')").groupBy((F.col("event_id") % 900).alias("pid")).agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("a"), F.max_by("event_type", F.struct("ts", "event_id")).alias("b"), F.count("*").alias("n"))
    return e.filter("n > 1").groupBy((F.col("a") == F.col("b")).alias("agree")).agg(F.count("*").alias("proposals"))


@query("select coalesce(source, '') as source, count(*) filter (year(pubdate) = 2025) as y2025, count(*) filter (year(pubdate) = 2026) as y2026, count(*) as total from articles where pubdate is not null group by 1")
def years_across(spark, d):
    a = table(spark, d, "articles").filter("pubdate is not null").select(F.coalesce("source", F.lit("")).alias("source"), F.year("pubdate").alias("y"))
    p = a.groupBy("source").pivot("y", [2025, 2026]).agg(F.count(F.lit(1)))
    return p.join(a.groupBy("source").agg(F.count("*").alias("total")), "source").select("source", F.coalesce("2025", F.lit(0)).alias("y2025"), F.coalesce("2026", F.lit(0)).alias("y2026"), "total")


@query("with a as (select id, coalesce(fetch_attempts, 0) as n from articles) select id, max(n)::int + 1 as attempts, max(n) + 1 >= 3 as given_up from a group by id")
def fetch_failures(spark, d):
    """One more failed reading of each article, and which are given up."""
    a = table(spark, d, "articles").groupBy("id").agg((F.max(F.coalesce("fetch_attempts", F.lit(0))) + 1).alias("attempts"))
    return a.withColumn("given_up", F.col("attempts") >= 3)


@query("select article_id, count(*) as rows_, min(id) as first from (select * from extracted_entities where article_id is not null and id % 2 = 0 union all select * from extracted_entities where article_id is not null and id % 2 = 1 and article_id not in (select article_id from extracted_entities where article_id is not null and id % 2 = 0)) group by article_id")
def rows_replaced(spark, d):
    """A second reading of some articles (even ids) replaces all rows of theirs, others stay: delete, then insert."""
    e = table(spark, d, "extracted_entities").filter("article_id is not null")
    new, old = e.filter("id % 2 = 0"), e.filter("id % 2 = 1")
    return old.join(new.select("article_id").distinct(), "article_id", "left_anti").select("article_id", "id").unionByName(new.select("article_id", "id")).groupBy("article_id").agg(F.count("*").alias("rows_"), F.min("id").alias("first"))


@query("with e as (select task, item, labeller, label, labelled_at, row_number() over (partition by task, item order by labelled_at, labeller, label) as k from eval_labels where task is not null and item is not null and labeller is not null and labelled_at is not null) select task, item, labeller as first_labeller from e where k = 1")
def first_labels(spark, d):
    w = Window.partitionBy("task", "item").orderBy("labelled_at", "labeller", "label")
    e = table(spark, d, "eval_labels").filter("task is not null and item is not null and labeller is not null and labelled_at is not null")
    return e.withColumn("k", F.row_number().over(w)).filter("k = 1").select("task", "item", F.col("labeller").alias("first_labeller"))
