"""Queries on cards and the review queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import cards as C
from . import _sql as S
from . import table
from .reference import query as _query

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    return _query(sql, QUERIES, SQL)


_HOSTS = (("www.zhonglan.example", "www.zaobao.com.sg"), ("www.merdu.example", "www.beritaharian.sg"), ("www.kuralmedai.example", "www.tamilmurasu.com.sg"))


def _hosted(url):
    for a, b in _HOSTS:
        url = F.replace(url, F.lit(a), F.lit(b))
    return url


def _hosted_sql(c):
    for a, b in _HOSTS:
        c = f"replace({c}, '{a}', '{b}')"
    return c


def _articles(spark, d):
    return table(spark, d, "articles").withColumn("url", _hosted(F.col("url")))


def _props(spark, d):
    return C.proposals(table(spark, d, "candidate_matches"), table(spark, d, "extracted_entities"), _articles(spark, d))


_PROPS = f"""
art as (select id as article, min({_hosted_sql('url')}) as link, min(pubdate) as pubdate from articles group by id),
props as (select distinct c.id as pid, c.extracted_id, case when coalesce(c.matched_uid, '') <> '' then 'uid:' || c.matched_uid else 'new:' || e.entity_type || ':' || {S.loose("coalesce(nullif(e.entity_name_en, ''), e.entity_name)")} end as card,
  e.entity_type as kind, e.entity_name as name, nullif(c.matched_uid, '') as uid, a.link, strftime(a.pubdate, '%Y-%m-%d') as day, e.article_id as article
  from candidate_matches c join extracted_entities e on e.id = c.extracted_id left join art a on a.article = e.article_id where e.entity_name is not null and e.entity_type is not null),
deck as (select card, min(kind) as kind, arg_max(name, (length(name), name)) as entity, list_sort(list(distinct pid)) as pids,
  list_sort(list(distinct case when link like '%zaobao%' then 'zh' when link like '%beritaharian%' then 'ms' when link like '%tamilmurasu%' then 'ta' else 'en' end)) as langs, max(day) as newest,
  arg_max(coalesce(article, -1), (coalesce(day, ''), coalesce(article, -1))) as top_article,
  case min(kind) when 'PERSON' then 'people' when 'ORGANISATION' then 'organisations' when 'LEGAL_ACT' then 'legal acts' else 'everything else' end as grp, max(uid) is null as fresh from props group by card)"""


@query(f"with {_PROPS} select card, kind, entity, array_to_string(pids, ',') as pids, array_to_string(langs, ',') as langs, newest, top_article, grp, fresh from deck")
def card_deck(spark, d):
    return C.cards(_props(spark, d)).withColumn("pids", F.array_join("pids", ",")).withColumn("langs", F.array_join("langs", ","))


@query(f"with {_PROPS} select card, row_number() over (order by newest desc nulls last, top_article desc, entity, card) - 1 as ord from deck")
def card_order(spark, d):
    return C.ordered_positions(C.cards(_props(spark, d)), C.deal_order()).select("card", "ord")


def _reviews(spark, d):
    """Events as decisions on proposals: the last of a proposal stands, a view keeps it unsure."""
    e = table(spark, d, "events").filter("event_type in ('purchase', 'signup', 'view')").withColumn("pid", F.col("event_id") % 900)
    last = e.groupBy("pid").agg(F.max_by(F.struct("user_id", "event_type"), F.struct("ts", "event_id")).alias("m"), F.array_sort(F.collect_set(F.when(F.col("event_type") == "view", F.col("user_id")))).alias("kept"))
    verdict = F.when(F.col("m.event_type") == "purchase", "approve").when(F.col("m.event_type") == "signup", "reject").otherwise("unsure")
    return last.select("pid", F.col("m.user_id").alias("reviewer"), verdict.alias("verdict"), F.when(verdict == "unsure", F.col("kept")).otherwise(F.array().cast("array<bigint>")).alias("kept_by"))


_REVIEWS = """
rev as (select event_id % 900 as pid, arg_max(user_id, (ts, event_id)) as reviewer, case arg_max(event_type, (ts, event_id)) when 'purchase' then 'approve' when 'signup' then 'reject' else 'unsure' end as verdict,
  case when arg_max(event_type, (ts, event_id)) = 'view' then list(distinct user_id) filter (event_type = 'view') else [] end as kept_by from events where event_type in ('purchase', 'signup', 'view') group by event_id % 900)"""


@query(f"with {_PROPS}, {_REVIEWS}, p as (select card, unnest(pids) as pid from deck) select card, bool_and(pid in (select pid from rev where verdict <> 'unsure')) as settled from p group by card")
def settled_cards(spark, d):
    return C.settled(C.cards(_props(spark, d)), _reviews(spark, d))


_OPEN = "op as (select distinct card from (select card, unnest(pids) as pid from deck) p left join rev using (pid) where rev.verdict is null or (rev.verdict = 'unsure' and rev.reviewer <> 17 and not list_contains(rev.kept_by, 17)))"


@query(f"with {_PROPS}, {_REVIEWS}, {_OPEN} select card from op")
def cards_open_for_one(spark, d):
    return C.open_for(C.cards(_props(spark, d)), _reviews(spark, d), F.lit(17)).select("card")


@query(f"""with {_PROPS}, {_REVIEWS}, {_OPEN}, st as (select card from (select card, unnest(pids) as pid from deck) group by card having bool_and(pid in (select pid from rev where verdict <> 'unsure'))),
cl as (select entity, max(ts) as last_ from (select d.card as entity, e.ts from deck d join events e on e.event_type = 'click' and e.event_id % 900 = d.pids[1]) group by entity)
select card, row_number() over (order by fresh, newest desc nulls last, top_article desc, card) - 1 as place from deck where card in (select card from op) and card not in (select card from st) and list_has_any(langs, ['en', 'zh'])
and card not in (select entity from cl where last_ > (select max(ts) from events) - interval 60 minute)""")
def queue_of_one(spark, d):
    """Clicks hold a card; what one reviewer who reads two languages would be dealt, in order."""
    deck, e = C.cards(_props(spark, d)), table(spark, d, "events")
    now = e.agg(F.max("ts").alias("now")).first()["now"]
    claims = deck.select("card", (F.col("pids")[0]).alias("pid")).join(e.filter("event_type = 'click'").select((F.col("event_id") % 900).alias("pid"), F.col("user_id").alias("reviewer"), F.col("ts").cast("timestamp").alias("claimed_at")), "pid")
    q = C.queue_for(deck, _reviews(spark, d), claims, F.lit(17), F.lit(now).cast("timestamp"), ["en", "zh"])
    return C.ordered_positions(q, [F.col("fresh"), F.col("newest").desc_nulls_last(), F.col("top_article").desc(), F.col("card")], "place").select("card", "place")


def _ups(spark, d):
    return C.updates(table(spark, d, "candidate_matches"), _props(spark, d))


_UPS = f"""{_PROPS}, ups as (select distinct p.card, p.uid, p.link, u.field as field, u.strategy as strategy, u.value as value, p.pid from (select id, unnest(field_updates) as u from candidate_matches) c join (select distinct pid, card, uid, link from props) p on p.pid = c.id where u.field is not null and u.value is not null)"""
_LISTED = f"""{_UPS}, lv as (select card, field, link, v, {S.value_key('v')} as key from (select card, field, link, unnest({S.parts('value')}) as v from ups where strategy = 'APPEND')),
listed as (select card, field, key, arg_max(v, (length(v), v)) as value, list_sort(list(distinct link) filter (link is not null)) as links from lv group by card, field, key)"""


@query(f"with {_LISTED} select card, field, key, value, coalesce(array_to_string(links, ' '), '') as links from listed")
def listed_values(spark, d):
    return C.listed_values(_ups(spark, d)).select("card", "field", "key", "value", F.array_join("links", " ").alias("links"))


def _stated(spark, d):
    e = table(spark, d, "extracted_entities").select(F.col("id").alias("extracted_id"), F.explode("fields").alias("field", "value")).filter("value is not null")
    return e.join(_props(spark, d).filter("link is not null").select("extracted_id", "card", "link").distinct(), "extracted_id").select("card", "field", "value", "link")


@query(f"""with {_LISTED}, said as (select distinct p.card, p.link, f.key as field, {S.value_key('v')} as key from (select id, e.key as key, unnest({S.parts('e.value')}) as v from (select id, unnest(map_entries(fields)) as e from extracted_entities) where e.value is not null) f
  join (select distinct extracted_id, card, link from props where link is not null) p on p.extracted_id = f.id),
more as (select l.card, l.field, l.key, s.link from listed l join said s on s.card = l.card and s.field = l.field and s.key = l.key)
select l.card, l.field, l.key, len(list_distinct(list_concat(coalesce(l.links, []), coalesce((select list(link) from more m where m.card = l.card and m.field = l.field and m.key = l.key), [])))) as sources from listed l""")
def credited_values(spark, d):
    return C.credited(C.listed_values(_ups(spark, d)), _stated(spark, d)).select("card", "field", "key", "sources")


_YEARED = "select distinct card, uid, link, field, strategy, field || ' (' || (1990 + pid % 3) || ')' as value, pid from ups"


@query(f"""with {_UPS}, y as ({_YEARED}), lv as (select card, field, link, v, {S.value_key('v')} as key, {S.value_key(S.no_year('v'))} as family from (select card, field, link, unnest({S.parts('value')}) as v from y where strategy = 'APPEND')),
one as (select distinct card, field, family, key from lv), giver as (select distinct card, field, family, key, link from lv where link is not null)
select o.card, o.field, o.family, string_agg(o.key, ' ; ' order by o.key) as "values" from one o group by o.card, o.field, o.family having count(*) > 1
and (select count(*) = count(distinct link) and count(*) > 0 from giver g where g.card = o.card and g.field = o.field and g.family = o.family)""")
def disputed_years(spark, d):
    """Each proposal's field with a year of its own as its value, so that families of values arise."""
    u = _ups(spark, d).withColumn("value", F.concat("field", F.lit(" ("), (1990 + F.col("pid") % 3).cast("string"), F.lit(")")))
    return C.disputes(C.listed_values(u)).select("card", "field", "family", F.array_join("values", " ; ").alias("values"))


@query(f"""with {_UPS}, k as (select *, {S.value_key('value')} as key from ups where strategy <> 'APPEND'), o as (select *, case when strategy = 'REPLACE' or (field = 'Description' and strategy = 'MERGE') then '*' else key end as one from k)
select card, field, strategy, arg_max(value, (length(value), value)) as value, count(distinct link) as supporters, count(distinct case when trim(value, ' ') <> '' then key end) > 1 as conflict from o group by card, field, strategy, one""")
def scalar_notes(spark, d):
    return C.scalar_notes(_ups(spark, d))


def _news(spark, d):
    e = table(spark, d, "extracted_entities").select(F.col("id").alias("extracted_id"), F.explode("fields").alias("field", "value")).filter("value is not null")
    p = _props(spark, d).filter("uid is not null").select("extracted_id", "card", "uid").distinct()
    return e.join(p, "extracted_id")


_DELTA = f"""{_PROPS}, nv as (select p.card, p.uid, p.extracted_id, f.e.key as field, f.e.value as raw from (select id, unnest(map_entries(fields)) as e from extracted_entities) f join (select distinct extracted_id, card, uid from props where uid is not null) p on p.extracted_id = f.id where f.e.value is not null),
nf as (select *, list_filter(list_transform(flatten(list_transform({S.parts('raw')}, lambda x: string_split(regexp_replace(x, '([)）])\\s*[,，、]\\s*([A-Z\\x{{3400}}-\\x{{9FFF}}])', '\\1' || chr(1) || '\\2', 'g'), chr(1)))), lambda x: trim(x, ' ')), lambda x: x <> '') as l from nv where field not in ('Name', 'Name (DisplayName)', 'Name (LCNA)', 'Name (Chinese)', 'Image Link', 'DBpedia URI', 'SN', 'Qualifier')),
ng as (select *, trim(case when field in ('Description', 'Achievements') then raw when field = 'Street Address' then array_to_string(list_filter(list_transform(l, lambda x: {S.gloss('x')}), lambda x: not regexp_matches(x, '[\\x{{3400}}-\\x{{9FFF}}\\x{{F900}}-\\x{{FAFF}}]')), ' | ') when field = 'Awards' then array_to_string(list_filter(l, lambda x: lower(x) <> 'senior counsel'), ' | ') else array_to_string(l, ' | ') end, ' ') as news from nf),
nh as (select n.*, trim(coalesce(e.fields[n.field], ''), ' ') as have from ng n left join entities e on e.uid = n.uid where news <> ''),
ni as (select *, {S.parts('have')} as held, list_transform({S.parts('have')}, lambda x: {S.value_key('x')}) as keys from nh),
nj as (select *, list_filter({S.parts('news')}, lambda v: not (list_contains(keys, {S.value_key('v')}) or list_contains(keys, {S.value_key(S.gloss('v'))}) or (field = 'Street Address' and {S.gloss('v')} <> '' and len(list_filter(held, lambda o: contains(lower(o), lower({S.gloss('v')})))) > 0))) as missing from ni),
dl as (select card, uid, extracted_id, field, have, news, case when field = 'Description' then case when have = '' then 'new' when have = news then 'same' else 'differs' end when len(held) = 0 then 'new' when len(missing) = 0 then 'same' else 'extra' end as state, missing from nj),
dd as (select *, case when field = 'Description' then case when state = 'same' then '' else news end else array_to_string(missing, ' | ') end as fresh from dl)"""


@query(f"with {_DELTA} select card, extracted_id, field, state, fresh from dd")
def card_deltas(spark, d):
    return C.delta(_news(spark, d), table(spark, d, "entities").select("uid", "fields")).select("card", "extracted_id", "field", "state", "fresh")


@query(f"""with {_DELTA}, cov as (select distinct p.card, u.field as field from (select id, unnest(field_updates) as u from candidate_matches) c join props p on p.pid = c.id where u.field is not null and u.value is not null)
select card, extracted_id, field, case when have <> '' then array_to_string({S.parts('have')}, ' | ') || ' | ' || fresh else fresh end as result from dd where field <> 'Description' and state in ('new', 'extra') and (card, field) not in (select card, field from cov)""")
def derived_changes(spark, d):
    return C.derived(C.delta(_news(spark, d), table(spark, d, "entities").select("uid", "fields")), _ups(spark, d)).select("card", "extracted_id", "field", "result")


_ASKED = "q as (select distinct entity_type as kind, entity_name as name from extracted_entities where entity_name is not null and entity_type in ('AWARD', 'FACILITY'))"
_OWN = f"""live as (select uid, entity_type as kind, name, canonical_uid from entities where is_active and name is not null), own as (select kind, uid, name from live where canonical_uid is null or canonical_uid = uid),
keyed as (select kind, uid, name as label, {S.plain('name')} as k, 0 as v from own union all select l.kind, o.uid, o.name, {S.plain('l.name')}, 1 from live l join own o on o.kind = l.kind and o.uid = l.canonical_uid where l.canonical_uid <> l.uid),
exact as (select kind, k, arg_min(uid, (v, uid)) as uid, arg_min(label, (v, uid)) as label from keyed group by kind, k), styled as (select kind, {S.house('name')} as h, min(uid) as uid, arg_min(name, uid) as label from own group by all having {S.house('name')} <> '')"""


@query(f"""with {_ASKED}, {_OWN}, f as (select q.kind, q.name, {S.plain('q.name')} as k, e.uid as e_uid, e.label as e_label, s.uid as h_uid, s.label as h_label from q left join exact e on e.kind = q.kind and e.k = {S.plain('q.name')} left join styled s on s.kind = q.kind and s.h = {S.house('q.name')}),
g as (select kind, name, coalesce(e_uid, h_uid) as uid, case when e_uid is not null then case when {S.plain('e_label')} <> k then e_label end else h_label end as as_ from f),
nm as (select kind, name from g where uid is null union select kind, name from own), w as (select distinct kind, name, unnest(list_filter(regexp_split_to_array(lower(name), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> '')) as w from nm),
gr as (select distinct kind, name, substr('  ' || w || ' ', i::bigint, 3) as gram from (select *, unnest(range(1, len(w)::bigint + 2)) as i from w)), n as (select kind, name, count(*) as n from gr group by all),
sh as (select a.kind, a.name as l, b.name as r, count(*) as c from gr a join gr b on a.kind = b.kind and a.gram = b.gram where (a.kind, a.name) in (select kind, name from g where uid is null) and (b.kind, b.name) in (select kind, name from own) group by all),
sim as (select s.kind, l, r, o.uid, round(c / (x.n + y.n - c), 6) as s from sh s join n x on x.kind = s.kind and x.name = l join n y on y.kind = s.kind and y.name = r join own o on o.kind = s.kind and o.name = r),
best as (select kind, l, r, uid from sim where s >= 0.6 qualify row_number() over (partition by kind, l order by s desc, r, uid) = 1)
select g.kind, g.name, g.uid, g.as_, best.r as nearest, best.uid as nearest_uid from g left join best on best.kind = g.kind and best.l = g.name""")
def records_by_name(spark, d):
    q = table(spark, d, "extracted_entities").filter("entity_name is not null and entity_type in ('AWARD', 'FACILITY')").select(F.col("entity_type").alias("kind"), F.col("entity_name").alias("name")).distinct()
    return C.find_records(q, table(spark, d, "entities").withColumnRenamed("entity_type", "kind"))


@query(f"""with {_OWN}, r as (select uid as id, e.key as field, e.value as value from (select uid, unnest(map_entries(fields)) as e from entities) where e.value is not null and e.key in ('Awards', 'Affiliations(groupName)', 'Parent Organisation', 'Founder')),
v as (select id, field, case field when 'Awards' then 'AWARD' when 'Founder' then 'PERSON' else 'ORGANISATION' end as kind, p[i] as v, i as at_ from (select id, field, {S.parts('value')} as p, unnest(generate_series(1, len({S.parts('value')}))) as i from r)),
t as (select *, t[j] as name, j from (select *, {S.tries('v')} as t, unnest(generate_series(1, len({S.tries('v')}))) as j from v)),
f as (select t.*, coalesce(case when e.uid is not null then e.label end, s.label) as called from t left join exact e on e.kind = t.kind and e.k = {S.plain('t.name')} left join styled s on s.kind = t.kind and s.h = {S.house('t.name')}),
o as (select id, field, at_, v, arg_min(called, j) filter (called is not null) as called from f group by id, field, at_, v), n as (select *, case when called is not null then called || case when {S.end_year('v')} <> '' then ' ' || {S.end_year('v')} else '' end else v end as new_ from o)
select id, field, string_agg(new_, ' | ' order by at_) as value, coalesce(string_agg(new_ || '=' || v, ' ; ' order by at_) filter (new_ <> v), '') as wrote from n group by id, field""")
def link_values_named(spark, d):
    e = table(spark, d, "entities").withColumnRenamed("entity_type", "kind")
    rows = e.select(F.col("uid").alias("id"), F.explode("fields").alias("field", "value")).filter("value is not null")
    return C.linked_values(rows, e)


@query(f"""with {_UPS}, u as (select card, uid, field, string_agg(value, ' | ' order by value, pid) as value from ups where strategy = 'APPEND' and uid is not null group by all),
e as (select card, uid, field, p[i] as v, i, {S.value_key('p[i]')} as k from (select card, uid, field, {S.parts('value')} as p, unnest(generate_series(1, len({S.parts('value')}))) as i from u)),
o as (select card, uid, field, k, min(i) as i, arg_min(v, i) as v from e group by all), h as (select uid, field, {S.value_key('x')} as k from (select uid, e.key as field, unnest({S.parts('e.value')}) as x from (select uid, unnest(map_entries(fields)) as e from entities)))
select card, uid, field, string_agg(v, ' | ' order by i) as value from o where (uid, field, k) not in (select uid, field, k from h) group by card, uid, field""")
def values_not_held(spark, d):
    u = _ups(spark, d).filter("strategy = 'APPEND' and uid is not null").groupBy("card", "uid", "field").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("value", "pid"))), lambda s: s["value"]), N.DELIMITER).alias("value"))
    return C.without_held(u, table(spark, d, "entities").select("uid", "fields"))


@query("with c as (select distinct id, extracted_id, list_max([c.similarity for c in candidates]) as s, candidates from candidate_matches) select distinct id, list_max([x.uid for x in candidates if x.similarity = s]) as uid from c where s >= 0.95 and extracted_id in (select id from extracted_entities)")
def omitted_exact_hits(spark, d):
    """All decisions as if no answer had been given."""
    m = table(spark, d, "candidate_matches").withColumn("reasoning", F.lit(C.OMITTED))
    return C.omitted_exact(m, table(spark, d, "extracted_entities"))


@query(f"""with t as (select id as article_id, {S.low("coalesce(min(title), '')")} as t from articles group by id), n as (select extracted_id as id, count(*) as n from candidate_matches group by all),
e as (select distinct x.id, x.article_id, coalesce(x.role, '') as role, coalesce(x.entity_name <> '' and contains(t, {S.low('x.entity_name')}), false) or coalesce(x.entity_name_en <> '' and contains(t, {S.low('x.entity_name_en')}), false) or coalesce(x.entity_type in ('LEGAL_ACT', 'EVENT', 'AWARD', 'PROGRAMME'), false) as hit, coalesce(n.n, 0) as n
  from extracted_entities x left join t using (article_id) left join n on n.id = x.id where x.article_id is not null),
p as (select article_id, bool_or(role <> '') as roles, bool_or(hit) as hits, arg_max(id, (n, -id)) as most from e group by article_id)
select e.article_id, e.id from e join p using (article_id) where case when roles then role = 'subject' when hits then hit else id = most end""")
def article_subjects(spark, d):
    n = table(spark, d, "candidate_matches").groupBy(F.col("extracted_id").alias("id")).agg(F.count("*").alias("n"))
    return C.subjects(table(spark, d, "extracted_entities"), table(spark, d, "articles"), n)


_IDENT = "['" + "', '".join(C.IDENTIFYING) + "']"


@query(f"select uid, array_to_string(list_transform(list_filter({_IDENT}, lambda k: coalesce(fields[k], '') <> ''), lambda k: k || '=' || fields[k]), ' ; ') as facts from entities")
def identifying_facts(spark, d):
    return table(spark, d, "entities").select("uid", F.array_join(F.transform(C.identifying(F.col("fields")), lambda x: F.concat(x["key"], F.lit("="), x["value"])), " ; ").alias("facts"))


@query(f"""select uid, name, entity_type as kind, coalesce(nullif(fields['Occupation'], ''), nullif(fields['Title'], ''), nullif(fields['Description'], ''), nullif(fields['Feature Type'], ''), nullif(fields['Country'], ''), '')[1:64] as identity,
{S.tight("coalesce(fields['Description'], '')")}[1:120] as gist from entities where is_active and (canonical_uid is null or canonical_uid in ('', uid))""")
def search_index(spark, d):
    return C.search_rows(table(spark, d, "entities").withColumnRenamed("entity_type", "kind"))


@query(f"""with l as (select * from entities where is_active), v as (select a.canonical_uid as uid, trim(a.name, ' ') as name, a.uid as at_, o.name as own from l a left join l o on o.uid = a.canonical_uid where a.canonical_uid <> a.uid and a.canonical_uid <> '' and trim(a.name, ' ') <> ''),
k as (select uid, name, min(at_) as at_ from v where own is null or list_sort(list_filter(string_split({S.sub(S.low('name'), '[^\\p{L}\\p{N}_]+', ' ')}, ' '), lambda x: x <> '')) <> list_sort(list_filter(string_split({S.sub(S.low('own'), '[^\\p{L}\\p{N}_]+', ' ')}, ' '), lambda x: x <> '')) group by all)
select uid, string_agg(name, ' ; ' order by at_, name) as names from k group by uid""")
def variant_names(spark, d):
    return C.variant_names(table(spark, d, "entities")).select("uid", F.array_join("names", " ; ").alias("names"))
