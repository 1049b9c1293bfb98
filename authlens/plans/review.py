"""Queries on rewrites, dealing, news and the secondary compositions of the review."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import text as T
from ..operators import cards as C
from ..operators import components, dealing, edits, evaluation, reach
from . import _sql as S
from . import desk, table
from .general import _LOADS
from .reference import _STORY, _VOTES, _votes
from .reference import query as _query

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    return _query(sql, QUERIES, SQL)


def _rewrites(spark, d):
    """Each mention's summary as a rewrite of what its record says of itself, the latter's first words kept."""
    m = table(spark, d, "candidate_matches").filter("matched_uid is not null").select("extracted_id", F.col("matched_uid").alias("uid")).distinct()
    r = table(spark, d, "entities").select("uid", F.coalesce(F.try_element_at("fields", F.lit("Description")), F.lit("")).alias("old"))
    e = table(spark, d, "extracted_entities").filter("summary is not null").select(F.col("id").alias("extracted_id"), "summary")
    return m.join(r, "uid").join(e, "extracted_id").withColumn("new", F.trim(F.concat_ws(" ", "old", "summary")))


_REWRITES = "rw as (select m.extracted_id, m.uid, coalesce(r.fields['Description'], '') as old, trim(coalesce(r.fields['Description'], '') || ' ' || e.summary, ' ') as new_ from (select distinct extracted_id, matched_uid as uid from candidate_matches where matched_uid is not null) m join entities r on r.uid = m.uid join extracted_entities e on e.id = m.extracted_id where e.summary is not null)"


@query(f"""with {_REWRITES}, w as (select *, new_[length(old) + 1:] as more from rw) select extracted_id, uid, case when trim(more, ' ') = '' then 'drop' when old <> '' and len(list_filter(string_split(more, ' '), lambda x: x <> '')) < 4 and not regexp_matches(more, '\\b(1[89]|20)\\d{{2}}\\b') then 'drop' else 'keep' end as verdict, 1.0::double as kept from w""")
def rewrites_judged(spark, d):
    """A text with sentences put after it keeps all of itself."""
    x = _rewrites(spark, d).withColumn("c", edits.change(F.col("old"), F.col("new")))
    return x.select("extracted_id", "uid", "c.verdict", F.round("c.kept", 6).alias("kept"))


@query()
def rewrite_pieces(spark, d):
    x = _rewrites(spark, d).withColumn("c", edits.change(F.col("new"), F.col("summary")))
    return x.select("extracted_id", "uid", F.explode("c.pieces").alias("p")).groupBy("extracted_id", "uid", "p.kind").agg(F.count("*").alias("pieces"))


@query()
def rewrite_sentences(spark, d):
    x = _rewrites(spark, d).withColumn("e", edits.sentence_edits(F.col("old"), F.col("new")))
    return x.select("extracted_id", "uid", F.explode("e").alias("e")).select("extracted_id", "uid", "e.at", "e.upto", "e.text")


_COUNT = lambda c: f"len(list_filter(string_split(regexp_replace({S.sub(S.sub(c, '^' + S.WS + '+|' + S.WS + '+$'), S.ABBREVIATION, '@#@')}, '([.!?])' || '{S.WS}' || '+([A-Z0-9\"''(])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda v: v <> ''))"


@query(f"with {_REWRITES} select extracted_id, uid, {_COUNT('new_')}::int as sentences, {_COUNT('new_')} > 5 and {_COUNT('new_')} > {_COUNT('old')} as over from rw")
def sentence_limits(spark, d):
    x = _rewrites(spark, d)
    return x.select("extracted_id", "uid", T.sentence_count(F.col("new")).alias("sentences"), T.over_limit(F.col("old"), F.col("new")).alias("over"))


_TOKENS = lambda c: f"list_distinct(list_concat({S.content(c)}, regexp_extract_all({c}, '[\\x{{4E00}}-\\x{{9FFF}}]')))"


_NEIGHBOUR = "nb as (select distinct id, article_id, summary, evidence, lead(evidence) over (partition by article_id order by id) as other from (select distinct on (id) * from extracted_entities where article_id is not null and evidence is not null))"


@query(f"""with {_NEIGHBOUR}, c as (select id, article_id, string_split(other, ' ')[1] as name, {_TOKENS('other')} as tokens, {_TOKENS("coalesce(summary, '')")} as own from nb where other is not null), s as (select id as q, article_id, evidence as said, {_TOKENS('evidence')} as t from nb),
x as (select c.id, q, len(list_intersect(tokens, t)) / len(tokens) as s, len(list_intersect(tokens, own)) / len(tokens) as o from c join s on s.article_id = c.article_id and q <> c.id where len(tokens) > 0 and contains(lower(said), lower(name)))
select id, arg_max(q, (s, -q)) as quote_id from x where s >= 0.5 and s - o >= 0.2 group by id""")
def better_quotes(spark, d):
    """What the next mention's sentence says, put to each mention: whose sentence backs it."""
    e = table(spark, d, "extracted_entities").filter("article_id is not null and evidence is not null").select("id", "article_id", "summary", "evidence").dropDuplicates(["id"])
    e = e.withColumn("other", F.lead("evidence").over(Window.partitionBy("article_id").orderBy("id")))
    c = e.filter("other is not null").select("id", "article_id", F.col("id").alias("mention"), F.substring_index("other", " ", 1).alias("name"), N.fact_tokens(F.col("other")).alias("tokens"), N.fact_tokens(F.coalesce("summary", F.lit(""))).alias("own"))
    s = e.select("article_id", F.col("id").alias("mention"), F.col("evidence").alias("said"), N.fact_tokens(F.col("evidence")).alias("tokens"))
    return edits.best_quotes(c, s)


@query(f"""with m as (select distinct c.matched_uid as uid, e.id, e.article_id, e.summary as t from candidate_matches c join extracted_entities e on e.id = c.extracted_id where c.matched_uid is not null and e.summary is not null and e.article_id is not null),
w as (select *, {S.content('t')} as w, list_distinct(list_transform(regexp_extract_all(t, '[0-9][0-9,.]*[0-9]|[0-9]'), lambda x: replace(x, ',', ''))) as n from m)
select x.uid, x.id as a, y.id as b, len(list_filter(x.n, lambda v: not list_contains(y.n, v))) > 0 and len(list_filter(y.n, lambda v: not list_contains(x.n, v))) > 0 as differ from w x join w y on x.uid = y.uid and x.id < y.id and x.article_id <> y.article_id
where least(len(x.w), len(y.w)) >= 3 and len(list_intersect(x.w, y.w)) >= 0.75 * least(len(x.w), len(y.w))""")
def rival_sentences(spark, d):
    c = table(spark, d, "candidate_matches").filter("matched_uid is not null").select(F.col("extracted_id").alias("id"), F.col("matched_uid").alias("uid")).distinct()
    e = table(spark, d, "extracted_entities").filter("summary is not null and article_id is not null").select("id", "article_id", F.col("summary").alias("t")).distinct()
    return edits.rival_sentences(c.join(e, "id"), "uid", "id", "t", "article_id")


def _desks(spark, d):
    deck = C.ordered_positions(C.cards(desk._props(spark, d)), [F.col("fresh"), *C.deal_order()])
    return deck.select(F.concat("grp", F.lit("/"), F.col("langs")[0]).alias("desk"), "ord", "card", "pids")


@query()
def desk_replay(spark, d):
    """Events as commands at the desks, a user always at one desk."""
    desks = _desks(spark, d)
    names = desks.select("desk").distinct().withColumn("n", F.row_number().over(Window.orderBy("desk")) - 1)
    k = names.count() or 1
    e = table(spark, d, "events").withColumn("n", F.col("user_id") % k).join(F.broadcast(names), "n")
    verb = F.when(F.col("event_type").isin("view", "signup"), "take").when(F.col("event_type") == "click", "renew").when(F.col("event_type") == "error", "release").otherwise("decide")
    verdict = F.when(F.col("value") > 100, "approve").when(F.col("value") > 50, "reject").otherwise("unsure")
    none = F.lit(None)
    cmds = e.select("desk", F.col("event_id").alias("seq"), "ts", F.col("user_id").alias("who"), verb.alias("verb"), none.cast("string").alias("card"), none.cast("long").alias("pid"), verdict.alias("verdict"))
    return dealing.replay_desks(desks, cmds)


@query()
def labelling_replay(spark, d):
    """The evaluation labels as takes and saves, each labeller taking what comes next."""
    e = table(spark, d, "eval_labels").filter("task is not null and item is not null and labeller is not null and labelled_at is not null").distinct()
    items = C.ordered_positions(e.select("task", "item").distinct(), [F.col("task"), F.col("item")]).select("task", (F.col("ord") + 1).alias("ord"), "item")
    at = F.xxhash64("task", "item", "labeller")
    cmds = e.select("task", at.alias("seq"), F.col("labelled_at").alias("ts"), "labeller", F.lit("take").alias("verb"), F.lit(None).cast("string").alias("item"))
    cmds = cmds.unionByName(e.select("task", at.alias("seq"), (F.col("labelled_at") + F.expr("interval 30 seconds")).alias("ts"), "labeller", F.lit("save").alias("verb"), F.lit(None).cast("string").alias("item")))
    return dealing.replay_labelling(items, cmds, 50)


_ITEMS = f"""{_VOTES}, items as (select task, item, row_number() over (partition by task order by item) as ord from (select distinct task, item from eval_labels where task is not null and item is not null)),
lab as (select distinct task, item, labeller from usable), one as (select min(labeller) as me from usable)"""


@query(f"""with {_ITEMS}, langs as (select i.*, case when item like '%zhonglan%' then 'zh' when item like '%merdu%' then 'ms' when item like '%kuralmedai%' then 'ta' else 'en' end as lang from items i),
f as (select l.*, (l.task, l.item) in (select task, item from lab) as labelled, (l.task, l.item) in (select task, item from lab, one where labeller = me) as mine from langs l)
select task, lang, count(*)::int as total, count(*) filter (ord <= 50)::int as shared, count(*) filter (ord <= 50 and mine)::int as shared_mine, count(*) filter (mine)::int as mine, count(*) filter (ord > 50 and labelled)::int as labelled, (select count(distinct labeller) from lab b where b.task = f.task)::int as labellers from f group by task, lang""")
def labelling_progress(spark, d):
    e = table(spark, d, "eval_labels").filter("task is not null and item is not null").select("task", "item").distinct()
    items = C.ordered_positions(e, [F.col("task"), F.col("item")])
    items = items.join(items.groupBy("task").agg(F.min("ord").alias("_f")), "task").withColumn("ord", F.col("ord") - F.col("_f") + 1)
    lab = _votes(spark, d).select("task", "item", "labeller").distinct()
    me = F.broadcast(lab.agg(F.min("labeller").alias("me")))
    per = lab.join(me, F.lit(True)).groupBy("task", "item").agg(F.max(F.col("labeller") == F.col("me")).alias("mine"))
    x = items.join(per, ["task", "item"], "left").withColumn("lang", C.language_of_address(desk._hosted(F.col("item"))))
    n = lab.groupBy("task").agg(F.countDistinct("labeller").cast("int").alias("labellers"))
    mine, shared = F.coalesce("mine", F.lit(False)), F.col("ord") <= 50
    count = lambda c: F.count(F.when(c, 1)).cast("int")
    out = x.groupBy("task", "lang").agg(F.count("*").cast("int").alias("total"), count(shared).alias("shared"), count(shared & mine).alias("shared_mine"), count(mine).alias("mine"), count(~shared & F.col("mine").isNotNull()).alias("labelled"))
    return out.join(n, "task", "left").withColumn("labellers", F.coalesce("labellers", F.lit(0)))


_FORM_SQL = lambda c: f"{S.tight(S.sub(S.low(c), '[^\\p{L}\\p{N}_]+', ' '))}"
_FORMS = f"""raw as (select uid, trim({S.tight(S.sub('name', r'\([^)]*\)', ' '))}, ' ') as b from entities where name is not null),
cut as (select uid, b, string_split(b, ',') as c, len(string_split(b, ',')) = 2 and not regexp_matches(b, '[\\x{{3400}}-\\x{{9FFF}}]') as two from raw),
each as (select distinct uid, unnest(case when two then [trim(c[1], ' ') || ' ' || trim(c[2], ' '), trim(c[2], ' ') || ' ' || trim(c[1], ' ')] else [b, regexp_replace(b, '^Singapore\\. ', '')] end) as f from cut),
fn as (select uid, {_FORM_SQL('f')} as f from each),
form as (select distinct uid, case when regexp_matches(f, '[\\x{{3400}}-\\x{{9FFF}}]') then replace(f, ' ', '') else f end as form from fn
  where case when regexp_matches(f, '[\\x{{3400}}-\\x{{9FFF}}]') then length(replace(f, ' ', '')) >= 3 else regexp_matches(f, '[a-z]') and (len(string_split(f, ' ')) >= 2 and len(list_filter(string_split(f, ' '), lambda w: length(w) > 1)) > 0 or len(string_split(f, ' ')) = 1 and length(f) >= 8) end)"""


@query(f"with {_FORMS} select uid, string_agg(form, ' ; ' order by form) as forms from form group by uid")
def printed_forms(spark, d):
    x = table(spark, d, "entities").filter("name is not null").select("uid", reach.forms(F.col("name")).alias("f")).filter("size(f) > 0")
    return x.select("uid", F.array_join(F.array_sort("f"), " ; ").alias("forms"))


@query(f"""with {_FORMS}, a as (select id, created_at::date as day, {_FORM_SQL("evidence")} as t from extracted_entities where evidence is not null and created_at is not null),
hit as (select f.uid, a.day, a.id from form f join a on case when regexp_matches(form, '[\\x{{3400}}-\\x{{9FFF}}]') then contains(t, form) else contains(' ' || t || ' ', ' ' || form || ' ') end where a.day >= '2026-02-01' and a.day < '2026-09-01')
select uid, strftime(min(day), '%Y-%m-%d') as day, arg_min(id, (day, id)) as id from hit group by uid""")
def first_printed(spark, d):
    """The first mention's evidence of seven months that prints each record's name."""
    a = table(spark, d, "extracted_entities").filter("evidence is not null and created_at is not null").select("id", F.to_date("created_at").alias("day"), F.col("evidence").alias("text"))
    n = table(spark, d, "entities").filter("name is not null").select(F.col("uid").alias("key"), "name", F.lit("2026-02-01").cast("date").alias("start"), F.lit("2026-09-01").cast("date").alias("stop"))
    return reach.first_printed(n, a).select(F.col("key").alias("uid"), F.date_format("day", "yyyy-MM-dd").alias("day"), "id")


@query("with n as (select distinct lower(name) as n from entities where is_active and length(name) >= 7) select distinct a.id from extracted_entities a join n on contains(lower(a.evidence), n.n)")
def evidence_with_names(spark, d):
    a = table(spark, d, "extracted_entities").select("id", F.col("evidence").alias("text")).filter("text is not null").distinct()
    return reach.names_any(a, table(spark, d, "entities").filter("is_active and name is not null").select("name"))


@query("""with p as (select id, entity_name as n, list_filter(list_transform(string_split(regexp_replace(evidence, '([.!?])\\s+|([。！？])', '\\1\\2' || chr(1), 'g'), chr(1)), lambda s: trim(s, ' ')), lambda s: s <> '') as s from extracted_entities where evidence is not null and entity_name is not null)
select distinct id, array_to_string(list_filter(s, lambda x: contains(x, n))[1:2], ' // ') as said from p""")
def sentences_naming(spark, d):
    e = table(spark, d, "extracted_entities").filter("evidence is not null and entity_name is not null")
    return e.select("id", F.array_join(reach.sentences_with(F.col("evidence"), F.col("entity_name")), " // ").alias("said")).distinct()


_VETO = """c as (select distinct extracted_id, c.uid as uid from (select extracted_id, unnest(candidates) as c from candidate_matches)),
v as (select c.extracted_id, c.uid, e.entity_type as kind, year(e.created_at) as y, try_cast(nullif(regexp_extract(r.fields['Death Year (yyyy)'], '([0-9]{4})', 1), '') as int) as died, try_cast(nullif(regexp_extract(r.fields['Birth Year (yyyy)'], '([0-9]{4})', 1), '') as int) as born, try_cast(regexp_extract(e.fields['Age'], '^([0-9]{2})$', 1) as int) as age
  from c join extracted_entities e on e.id = c.extracted_id join entities r on r.uid = c.uid)"""


@query(f"with {_VETO} select extracted_id, uid, case when died < y - 1 then 'died' else 'age' end as why from v where died < y - 1 or (kind = 'PERSON' and age between 15 and 105 and abs(y - age - born) > 2)")
def candidates_vetoed(spark, d):
    """Ages as a text would print them after the name, from the field the reader filled."""
    c = table(spark, d, "candidate_matches").select("extracted_id", F.explode("candidates").alias("c")).select("extracted_id", "c.uid").distinct()
    e = table(spark, d, "extracted_entities")
    age = F.when(F.try_element_at("fields", F.lit("Age")).rlike("^[0-9]{2}$"), F.concat("entity_name", F.lit(", aged "), F.try_element_at("fields", F.lit("Age")), F.lit(", spoke.")))
    m = e.select(F.col("id").alias("extracted_id"), F.col("entity_type").alias("kind"), F.year("created_at").alias("y"), F.coalesce(reach.ages_near(age, F.col("entity_name")), F.array().cast("array<int>")).alias("ages"))
    r = table(spark, d, "entities").select("uid", F.col("fields").alias("rf"))
    x = c.join(m, "extracted_id").join(r, "uid")
    return x.select("extracted_id", "uid", reach.vetoed(F.col("kind"), F.col("rf"), F.col("ages"), F.col("y")).alias("why")).filter("why is not null")


_FACT = lambda c: "array_to_string(list_transform(string_split(regexp_replace(" + S.tight(S.sub(S.sub(S.low(c), r"\([^0-9)][^)]*\)|\(\)", " "), r"[^\p{L}\p{N}_]+", " ")) + ", '^singapore (.)', '\\1'), ' '), lambda w: case when length(w) > 3 and w[-1] = 's' and w[-2:] <> 'ss' then w[1:length(w) - 1] else w end), ' ')"


@query(f"select uid, key as field, {_FACT('v')} as fact from (select uid, e.key as key, e.value as v from (select uid, unnest(map_entries(fields)) as e from entities)) where v is not null")
def fact_keys(spark, d):
    return table(spark, d, "entities").select("uid", F.explode("fields").alias("field", "v")).filter("v is not null").select("uid", "field", reach.fact_norm(F.col("v")).alias("fact"))


_HELD = f"""{_LOADS}, snap as (select v.load_id, v.volume, d.snapshot, lag(d.snapshot) over (partition by v.volume order by d.idx) as previous from valid v join days d on d.volume = v.volume and d.snapshot = v.snapshot),
held as (select distinct trim(r.key_uid, ' ') as uid, trim(r.relationship_type, ' ') as field, trim(r.related_descriptor, ' ') as value, s.snapshot, s.previous from authority_rows r join snap s using (load_id) where coalesce(trim(r.related_uid, ' '), '') = '' and trim(r.related_descriptor, ' ') <> ''),
hk as (select *, {_FACT('value')} as k from held), facts as (select uid, field, upper(value) as value, snapshot - 20 as day from held where previous is not null and cast(uid as bigint) % 2 = 0),
fk as (select *, {_FACT('value')} as k from facts)"""


@query(f"""with {_HELD}, got as (select distinct f.uid, f.field, f.value, f.k, h.snapshot, h.previous from fk f join hk h on h.uid = f.uid and h.field = f.field and h.k = f.k where f.k <> '' and f.day >= h.previous and f.day < h.snapshot)
select distinct g.uid, g.field, g.value, strftime(g.snapshot, '%Y-%m-%d') as snapshot from got g where not exists (select 1 from hk b where b.uid = g.uid and b.field = g.field and b.k = g.k and b.snapshot = g.previous) and exists (select 1 from hk t where t.uid = g.uid and t.snapshot = g.previous)""")
def facts_read_before(spark, d):
    """What the next snapshot holds, as an article twenty days before would have written it, of every second record: which of it was new then."""
    from ..operators.snapshots import valid_loads

    loads = valid_loads(table(spark, d, "tte_imports"))
    days = loads.select("volume", "snapshot").distinct().withColumn("previous", F.lag("snapshot").over(Window.partitionBy("volume").orderBy("snapshot")))
    loads = loads.select("load_id", "volume", "snapshot").join(days, ["volume", "snapshot"])
    r = table(spark, d, "authority_rows").filter((F.coalesce(F.trim("related_uid"), F.lit("")) == "") & (F.trim("related_descriptor") != ""))
    held = r.join(F.broadcast(loads), "load_id").select(F.trim("key_uid").alias("uid"), F.trim("relationship_type").alias("field"), F.trim("related_descriptor").alias("value"), "snapshot", "previous").distinct()
    facts = held.filter((F.col("uid").cast("long") % 2 == 0) & F.col("previous").isNotNull()).select("uid", "field", F.upper("value").alias("value"), F.date_sub("snapshot", 20).alias("day"))
    return reach.facts_backed(facts, held).withColumn("snapshot", F.date_format("snapshot", "yyyy-MM-dd"))


@query(f"""with recursive {_STORY}, x as (select c.id, c.key, c.outlet, c.t, regexp_replace(lower(coalesce(a.title, '') || ' ' || coalesce(a.description, '')), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g') as body, l.label from c join (select id, min(title) as title, min(description) as description from articles group by id) a on a.id = c.id join (select id, min(relevant::int) as label from articles where relevant is not null group by id) l on l.id = c.id),
links as (select min(id) over (partition by key) as a, id as b from x union select min(id) over (partition by trim(body, ' ')) as a, id as b from x), both_ as (select a, b from links where a <> b union select b, a from links where a <> b),
reach as (select id, id as seen from x union select r.id, e.b from reach r join both_ e on e.a = r.seen), root as (select id, min(seen) as root from reach group by id)
select root as id, count(*) as members, min(label)::int as label from root join x using (id) group by root having min(label) = max(label)""")
def labelled_stories(spark, d):
    """Groups of labelled articles that are one story or one text; groups whose labels disagree are left out, of each other the earliest stays."""
    a = table(spark, d, "articles")
    one = a.groupBy("id").agg(F.min("url").alias("url"), F.min("title").alias("title"), F.min("description").alias("description")).join(a.filter("relevant is not null").groupBy("id").agg(F.min(F.col("relevant").cast("int")).alias("label")), "id")
    one = one.withColumn("key", T.story_key(F.col("url"))).withColumn("body", F.trim(F.regexp_replace(F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("description", F.lit("")))), f"[^{N.WORDLIKE}]+", " ")))
    links = None
    for k in ("key", "body"):
        first = one.filter(F.col(k).isNotNull()).groupBy(k).agg(F.min("id").alias("a"))
        x = one.join(first, k).select("a", F.col("id").alias("b"))
        links = x if links is None else links.unionByName(x)
    g = components.components(links, one.select("id")).join(one.select("id", "label"), "id")
    return g.groupBy(F.col("root").alias("id")).agg(F.count("*").alias("members"), F.min("label").alias("label"), F.max("label").alias("_most")).filter("label = _most").drop("_most")


@query("select distinct id, case when pubdate is null or coalesce(title, '') = '' then 'skipped' when pubdate < '2026-05-01' then 'train' when pubdate < '2026-08-01' then 'val' else 'test' end as part, id % 2 = 0 as even from articles")
def time_splits(spark, d):
    p = F.col("pubdate")
    part = F.when(p.isNull() | (F.coalesce("title", F.lit("")) == ""), "skipped").when(p < F.lit("2026-05-01").cast("timestamp"), "train").when(p < F.lit("2026-08-01").cast("timestamp"), "val").otherwise("test")
    return table(spark, d, "articles").select("id", part.alias("part"), (F.col("id") % 2 == 0).alias("even")).distinct()


@query("""with t as (select id, case when year(pubdate) is null then 0 else year(pubdate) * 100 + month(pubdate) end as period, case when relevant then 'kept' else 'other' end as stratum from (select id, min(pubdate) as pubdate, coalesce(bool_or(relevant), false) as relevant from articles group by id)),
r as (select *, row_number() over (partition by stratum, period order by md5('1:' || id), id) as k, count(*) over (partition by stratum, period) as n from t) select id, stratum, period, round(n / least(n, 3), 6) as weight from r where k <= 3""")
def drawn_by_month(spark, d):
    a = table(spark, d, "articles").groupBy("id").agg(F.min("pubdate").alias("pubdate"), F.coalesce(F.bool_or("relevant"), F.lit(False)).alias("relevant"))
    x = a.select("id", F.when(F.col("relevant"), "kept").otherwise("other").alias("stratum"), F.coalesce(F.year("pubdate") * 100 + F.month("pubdate"), F.lit(0)).alias("period"))
    return evaluation.draw(x, ["stratum", "period"], "id", 3)


@query("""with q as (select distinct extracted_id, id, matched_uid, (list_max([c.similarity for c in candidates]))::double as p from candidate_matches), b as (select extracted_id, arg_max(matched_uid, (p, id)) as uid, max(p) as p from q group by all)
select extracted_id, uid, case when p is null then 'missing' when p >= 0.8 then 'match' when p <= 0.45 then 'new' else 'ambiguous' end as action from b""")
def decisions_by_score(spark, d):
    q = table(spark, d, "candidate_matches").select("extracted_id", "id", "matched_uid", F.array_max(F.transform("candidates", lambda c: c["similarity"])).alias("p")).distinct()
    b = q.groupBy("extracted_id").agg(F.max_by("matched_uid", F.when(F.col("p").isNotNull(), F.struct("p", "id"))).alias("uid"), F.max("p").alias("p"))
    action = F.when(F.col("p").isNull(), "missing").when(F.col("p") >= 0.8, "match").when(F.col("p") <= 0.45, "new").otherwise("ambiguous")
    return b.select("extracted_id", "uid", action.alias("action"))


@query("""with c as (select distinct extracted_id, c.uid as uid, c.similarity as s from (select extracted_id, unnest(candidates) as c from candidate_matches)), f as (select *, row_number() over (partition by extracted_id order by s desc, uid) as fwd, row_number() over (partition by extracted_id order by round(s, 1) desc, uid desc) as rev from c)
select extracted_id, max(case when fwd = 1 then uid end) as uid, max(case when fwd = 1 then uid end) = max(case when rev = 1 then uid end) as stable from f group by extracted_id""")
def decisions_in_two_orders(spark, d):
    """Whether the best candidate is the same when likeness is coarse and the order turned."""
    c = table(spark, d, "candidate_matches").select("extracted_id", F.explode("candidates").alias("c")).select("extracted_id", "c.uid", F.col("c.similarity").alias("s")).distinct()
    x = c.groupBy("extracted_id").agg(F.max_by("uid", F.struct("s", -F.col("uid").cast("long"))).alias("uid"), F.max_by("uid", F.struct(F.round("s", 1), F.col("uid"))).alias("_rev"))
    return x.select("extracted_id", "uid", (F.col("uid") == F.col("_rev")).alias("stable"))


@query("""with v as (select user_id, event_id, value, row_number() over (partition by user_id order by ts, event_id) as k from events), t as (select user_id, k, 1 + (floor(value)::int % 5) as a from v where k <= 10)
select user_id, sum(case when k % 2 = 1 then a - 1 else 5 - a end) * 2.5::double as score from t group by user_id having count(*) = 10""")
def usability_scores(spark, d):
    """Users' first ten events as ten answers of 1 to 5: odd ones count one less, even ones what they lack to five, times 2.5."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    t = table(spark, d, "events").withColumn("k", F.row_number().over(w)).filter("k <= 10").withColumn("a", 1 + F.floor("value").cast("int") % 5)
    s = F.when(F.col("k") % 2 == 1, F.col("a") - 1).otherwise(5 - F.col("a"))
    return t.groupBy("user_id").agg((F.sum(s) * 2.5).cast("double").alias("score"), F.count("*").alias("_n")).filter("_n = 10").drop("_n")


@query("""with c as (select extracted_id, min(case resolution_action when 'MATCH_AND_UPDATE' then 1 when 'CREATE_NEW' then 2 when 'FLAG_AMBIGUOUS' then 3 else 4 end) as r from candidate_matches group by all), o as (select e.id, coalesce(r, 5) as r from (select distinct id from extracted_entities) e left join c on c.extracted_id = e.id)
select case r when 1 then 'matched' when 2 then 'new' when 3 then 'ambiguous' when 4 then 'flagged' else 'waiting' end as outcome, count(*) as mentions, round(count(*) / sum(count(*)) over (), 6) as share from o group by r""")
def decision_funnel(spark, d):
    """Each mention under the most active outcome it has."""
    r = F.when(F.col("resolution_action") == "MATCH_AND_UPDATE", 1).when(F.col("resolution_action") == "CREATE_NEW", 2).when(F.col("resolution_action") == "FLAG_AMBIGUOUS", 3).otherwise(4)
    c = table(spark, d, "candidate_matches").groupBy(F.col("extracted_id").alias("id")).agg(F.min(r).alias("r"))
    o = table(spark, d, "extracted_entities").select("id").distinct().join(c, "id", "left").groupBy(F.coalesce("r", F.lit(5)).alias("r")).agg(F.count("*").alias("mentions"))
    name = F.element_at(F.array(*map(F.lit, ("matched", "new", "ambiguous", "flagged", "waiting"))), F.col("r"))
    return o.join(F.broadcast(o.agg(F.sum("mentions").alias("_all"))), F.lit(True)).select(name.alias("outcome"), "mentions", F.round(F.col("mentions") / F.col("_all"), 6).alias("share"))


@query("select id, to_json({'id': id, 'title': coalesce(title, ''), 'description': coalesce(description, '')}) as payload from (select id, min(title) as title, min(description) as description from articles where relevant is null group by id)")
def articles_to_score(spark, d):
    a = table(spark, d, "articles").filter("relevant is null").groupBy("id").agg(F.min("title").alias("title"), F.min("description").alias("description"))
    return a.select("id", F.to_json(F.struct("id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("description", F.lit("")).alias("description"))).alias("payload"))


@query("""with w as (select article_id, id, resolved from extracted_entities where article_id is not null), a as (select article_id, bool_and(not resolved) as waiting, count(*) as n from w group by all), ans as (select distinct e.article_id, c.extracted_id as id from candidate_matches c join extracted_entities e on e.id = c.extracted_id where e.article_id is not null)
select case when a.waiting then 'written' else 'skipped' end as outcome, count(distinct s.article_id) as articles, count(*) as answers from ans s join a using (article_id) group by all""")
def answers_imported(spark, d):
    """An article's answers are written only while all its mentions still wait."""
    w = table(spark, d, "extracted_entities").filter("article_id is not null")
    a = w.groupBy("article_id").agg(F.min(~F.col("resolved")).alias("waiting"))
    ans = table(spark, d, "candidate_matches").select(F.col("extracted_id").alias("id")).join(w.select("id", "article_id"), "id").distinct()
    return ans.join(a, "article_id").groupBy(F.when(F.col("waiting"), "written").otherwise("skipped").alias("outcome")).agg(F.countDistinct("article_id").alias("articles"), F.count("*").alias("answers"))


@query("""with p as (select distinct id, article_id, case when confidence = 'high' then 1 when role = 'subject' then 2 when resolved then 3 end as pool from extracted_entities), r as (select *, row_number() over (partition by pool order by md5('1:' || id), id) as k from p where pool is not null) select id, pool::int as pool from r where k <= 20""")
def audit_pools(spark, d):
    """Twenty of each pool in a seeded order; a mention belongs to its first pool."""
    pool = F.when(F.col("confidence") == "high", 1).when(F.col("role") == "subject", 2).when(F.col("resolved"), 3)
    p = table(spark, d, "extracted_entities").select("id", "article_id", pool.alias("pool")).distinct().filter("pool is not null")
    w = Window.partitionBy("pool").orderBy(F.md5(F.concat(F.lit("1:"), F.col("id").cast("string"))), "id")
    return p.withColumn("k", F.row_number().over(w)).filter("k <= 20").select("id", "pool")


@query("select id, regexp_matches(entity_name, '[^\\x00-\\x{24F}\\x{1E00}-\\x{1EFF}\\x{2000}-\\x{206F}]') as other_script, case when regexp_matches(entity_name, '[\\x{0B80}-\\x{0BFF}]') then 'TAMtoENG' when regexp_matches(entity_name, '[\\x{3400}-\\x{9FFF}]') then 'CHItoENG' else 'MAYtoENG' end as link from extracted_entities where entity_name is not null")
def scripts_of_names(spark, d):
    n = F.col("entity_name")
    link = F.when(n.rlike(r"[\x{0B80}-\x{0BFF}]"), "TAMtoENG").when(n.rlike(r"[\x{3400}-\x{9FFF}]"), "CHItoENG").otherwise("MAYtoENG")
    return table(spark, d, "extracted_entities").filter("entity_name is not null").select("id", n.rlike(N.NON_LATIN).alias("other_script"), link.alias("link"))
