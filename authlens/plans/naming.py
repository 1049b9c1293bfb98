"""Queries of the rules on names, values and addresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import text as T
from . import _sql as S
from . import table
from .reference import query as _query

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    return _query(sql, QUERIES, SQL)


def _joined(spark, d):
    """Names beside each other: records' names, mentions' names, and both as a name with its gloss."""
    e = table(spark, d, "entities").filter("name is not null").select("uid", "name")
    return e


_PAIRED = """with p as (select e.uid, e.name || ' (' || c.name || ')' as v from entities e join entities c on c.uid = e.canonical_uid where e.uid <> c.uid and e.name is not null and c.name is not null)"""


def _paired(spark, d):
    """Each record's name with its next record's name in brackets."""
    e = table(spark, d, "entities")
    c = e.select(F.col("uid").alias("canonical_uid"), F.col("name").alias("other"))
    p = e.join(c, "canonical_uid").filter("uid <> canonical_uid and name is not null and other is not null")
    return p.select("uid", F.concat("name", F.lit(" ("), "other", F.lit(")")).alias("v"))


@query(f"select uid, {S.plain('name')} as plain, {S.house('name')} as house, {S.loose('name')} as loose, {S.value_key('name')} as value_key from entities where name is not null")
def names_as_keys(spark, d):
    n = F.col("name")
    return _joined(spark, d).select("uid", N.plain(n).alias("plain"), N.house(n).alias("house"), N.loose_name(n).alias("loose"), N.value_key(n).alias("value_key"))


@query(
    f"with y as (select uid, 'The ' || name || ' {'&'} Awards (' || cast(1950 + cast(uid as bigint) % 70 as varchar) || ')' as v, name from entities where name is not null) "
    f"select uid, {S.no_year('v')} as bare, {S.value_key(S.no_year('v'))} as family, name || ' ' || {S.end_year('v')} as renamed from y"
)
def names_with_years(spark, d):
    y = _joined(spark, d).withColumn("v", F.concat(F.lit("The "), "name", F.lit(" & Awards ("), (1950 + F.col("uid").cast("long") % 70).cast("string"), F.lit(")")))
    v = F.col("v")
    return y.select("uid", N.without_year(v).alias("bare"), N.family(v).alias("family"), N.renamed(v, F.col("name")).alias("renamed"))


@query(f"{_PAIRED} select uid, array_to_string({S.tries('v')}, '#') as tries, {S.gloss('v')} as gloss from p")
def names_to_try(spark, d):
    v = F.col("v")
    return _paired(spark, d).select("uid", F.array_join(N.tries_for(v), "#").alias("tries"), N.gloss(v).alias("gloss"))


@query(
    f"{_PAIRED}, t as (select uid, v, {S.tries('v')} as t from p), far as (select *, len(t) = 2 and regexp_matches(t[1], '[^\\x00-\\x{{24F}}\\x{{1E00}}-\\x{{1EFF}}\\x{{2000}}-\\x{{206F}}]') "
    f"and not regexp_matches(t[2], '[^\\x00-\\x{{24F}}\\x{{1E00}}-\\x{{1EFF}}\\x{{2000}}-\\x{{206F}}]') as two from t) "
    f"select uid, case when two then t[2] || case when {S.end_year('v')} <> '' then ' ' || {S.end_year('v')} else '' end else v end as english from far"
)
def names_in_english(spark, d):
    return _paired(spark, d).select("uid", N.english(F.col("v")).alias("english"))


def _field(v: str) -> str:
    return f"list_filter(list_transform(flatten(list_transform({S.parts(v)}, lambda x: string_split(regexp_replace(x, '([)）])\\s*[,，、]\\s*([A-Z\\x{{3400}}-\\x{{9FFF}}])', '\\1' || chr(1) || '\\2', 'g'), chr(1)))), lambda x: trim(x, ' ')), lambda x: x <> '')"


@query(
    "with f as (select id, unnest(map_entries(fields)) as e from extracted_entities), g as (select id, e.key as field, e.value || ' (甲), ' || e.value || ' (Chair)' as v from f where e.value is not null) "
    f"select id, field, len({_field('v')}) as entries, array_to_string({_field('v')}, ' | ') as listed from g"
)
def news_lists(spark, d):
    f = table(spark, d, "extracted_entities").select("id", F.explode("fields").alias("field", "value")).filter("value is not null")
    v = F.col("v")
    f = f.withColumn("v", F.concat("value", F.lit(" (甲), "), "value", F.lit(" (Chair)")))
    return f.select("id", "field", F.size(N.news_values(v)).cast("long").alias("entries"), F.array_join(N.news_values(v), " | ").alias("listed"))


@query(
    "with f as (select id, unnest(map_entries(fields)) as e from extracted_entities), g as (select id, e.key as field, e.value || ' | 路 (Hill Road) | Senior Counsel' as v from f where e.value is not null), "
    f"h as (select id, field, v, {_field('v')} as l from g) select id, field, case when field in ('Description', 'Achievements') then v when field = 'Awards' then array_to_string(list_filter(l, lambda x: lower(x) <> 'senior counsel'), ' | ') "
    f"when field = 'Street Address' then array_to_string(list_filter(list_transform(l, lambda x: {S.gloss('x')}), lambda x: not regexp_matches(x, '[\\x{{3400}}-\\x{{9FFF}}\\x{{F900}}-\\x{{FAFF}}]')), ' | ') else array_to_string(l, ' | ') end as clean from h"
)
def news_values_clean(spark, d):
    f = table(spark, d, "extracted_entities").select("id", F.explode("fields").alias("field", "value")).filter("value is not null")
    f = f.withColumn("v", F.concat("value", F.lit(" | 路 (Hill Road) | Senior Counsel")))
    return f.select("id", "field", N.clean_news_value(F.col("field"), F.col("v")).alias("clean"))


_NEXT = "select id, entity_name as a, lead(entity_name) over (partition by article_id order by id) as b from extracted_entities where entity_name is not null"


def _next(spark, d):
    from pyspark.sql import Window

    return table(spark, d, "extracted_entities").filter("entity_name is not null").select("id", F.col("entity_name").alias("a"), F.lead("entity_name").over(Window.partitionBy("article_id").orderBy("id")).alias("b")).filter("b is not null")


@query(
    f"with n as ({_NEXT}), w as (select id, list_sort(list_filter(string_split({S.sub(S.low('a'), '[^\\p{L}\\p{N}_]+', ' ')}, ' '), lambda x: x <> '')) as x, "
    f"list_sort(list_filter(string_split({S.sub(S.low('b'), '[^\\p{L}\\p{N}_]+', ' ')}, ' '), lambda x: x <> '')) as y from n where b is not null) select id, x = y as same from w"
)
def names_same_words(spark, d):
    return _next(spark, d).select("id", (N.word_bag(F.col("a")) == N.word_bag(F.col("b"))).alias("same"))


_PROSE = "select id, summary as a, evidence as b from extracted_entities where summary is not null and evidence is not null"


def _prose(spark, d):
    return table(spark, d, "extracted_entities").filter("summary is not null and evidence is not null").select("id", F.col("summary").alias("a"), F.col("evidence").alias("b"))


@query(
    f"with p as ({_PROSE}), w as (select id, a, b, {S.content('a')} as x, {S.content('b')} as y from p) select id, len(x) as words, len(list_intersect(x, y)) as shared, "
    f"least(len(x), len(y)) >= 3 and len(list_intersect(x, y)) >= 0.75 * least(len(x), len(y)) as near, len(list_distinct(list_concat(y, regexp_extract_all(b, '[\\x{{4E00}}-\\x{{9FFF}}]')))) as tokens from w"
)
def sentences_alike(spark, d):
    a, b = F.col("a"), F.col("b")
    x, y = N.content_words(a), N.content_words(b)
    return _prose(spark, d).select("id", F.size(x).cast("long").alias("words"), F.size(F.array_intersect(x, y)).cast("long").alias("shared"), N.near_same(a, b).alias("near"), F.size(N.fact_tokens(b)).cast("long").alias("tokens"))


@query(
    f"with p as ({_PROSE}), w as (select id, list_distinct(list_transform(regexp_extract_all(a || ' 17', '[0-9][0-9,.]*[0-9]|[0-9]'), lambda x: replace(x, ',', ''))) as x, list_distinct(list_transform(regexp_extract_all(b, '[0-9][0-9,.]*[0-9]|[0-9]'), lambda x: replace(x, ',', ''))) as y from p) "
    "select id, len(x) as numbers, len(list_filter(x, lambda v: not list_contains(y, v))) > 0 and len(list_filter(y, lambda v: not list_contains(x, v))) > 0 as differ from w"
)
def numbers_apart(spark, d):
    a, b = F.concat("a", F.lit(" 17")), F.col("b")
    return _prose(spark, d).select("id", F.size(N.numbers(a)).cast("long").alias("numbers"), N.numbers_differ(a, b).alias("differ"))


@query(
    f"with n as (select * from ({_NEXT}) where b is not null), w as (select id, a, b, regexp_extract_all({S.low(S.no_year('a'))}, '[\\p{{L}}\\p{{N}}_''’-]+') as ta, regexp_extract_all({S.low(S.no_year('b'))}, '[\\p{{L}}\\p{{N}}_''’-]+') as tb from (select id, a, b || ' ' || a as b from n)), "
    "s as (select id, a, b, case when len(ta) <= len(tb) then ta else tb end as s, case when len(ta) <= len(tb) then tb else ta end as l from w), "
    f"t as (select id, {S.content(chr(97) + 'rray_to_string(s, ' + chr(39) + ' ' + chr(39) + ')')} as cs, {S.content('array_to_string(l, ' + chr(39) + ' ' + chr(39) + ')')} as cl, s, l, least(3, len(s)) as n, a, b from s) "
    f"select id, len(s) > 0 and len(list_filter(cs, lambda v: not list_contains(cl, v))) = 0 and s[len(s) - n + 1 : len(s)] = l[len(l) - n + 1 : len(l)] or (len(s) >= 10 and least(len({S.content('a')}), len({S.content('b')})) >= 3 and len(list_intersect({S.content('a')}, {S.content('b')})) >= 0.75 * least(len({S.content('a')}), len({S.content('b')}))) as maybe from t"
)
def values_maybe_same(spark, d):
    """A name against another of its article with itself appended, so that both outcomes occur."""
    return _next(spark, d).select("id", N.maybe_same(F.col("a"), F.concat("b", F.lit(" "), "a")).alias("maybe"))


@query(
    "with u as (select c.id, unnest(c.field_updates) as u, e.fields from candidate_matches c join entities e on e.uid = c.matched_uid), x as (select id, u.field, u.strategy, u.value, "
    f"{S.parts('fields[u.field]')} as held from u) select id, field, strategy, value, case when strategy = 'APPEND' and len(held) > 0 then array_to_string(held, ' | ') || ' | ' || value else value end as result from x where value is not null"
)
def results_of_changes(spark, d):
    c = table(spark, d, "candidate_matches").select("id", "matched_uid", F.explode("field_updates").alias("u")).select("id", "matched_uid", "u.*").filter("value is not null")
    held = table(spark, d, "entities").select(F.col("uid").alias("matched_uid"), "fields")
    x = c.join(held, "matched_uid").withColumn("held", N.values(F.try_element_at("fields", "field")))
    return x.select("id", "field", "strategy", "value", N.result_of(F.col("strategy"), F.col("held"), F.col("value")).alias("result"))


_HOSTS = (("www.straitline.example", "www.straitstimes.com"), ("www.zhonglan.example", "www.zaobao.com.sg"), ("www.islandwire.example", "www.channelnewsasia.com"))


def _as_hosts(c: str) -> str:
    for a, b in _HOSTS:
        c = f"replace({c}, '{a}', '{b}')"
    return c


_ADDRESS = f"select id, {_as_hosts('url')} || case when url like '%zhonglan%' then '/story20260101-' || id else '' end as url from articles where url is not null"


@query(
    f"with u as ({_ADDRESS}), h as (select id, url, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\\.', '') as host, rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') as path from u), "
    "o as (select *, case when host like '%channelnewsasia.com' then 'cna' when host like '%straitstimes.com' then 'st' when contains(host, 'zaobao') then 'zaobao' else host end as outlet, string_split(path, '/')[-1] as last from h) "
    "select distinct id, outlet, case when outlet = 'cna' and regexp_matches(last, '-\\d{6,}$') then 'cna:' || regexp_extract(last, '-(\\d{6,})$', 1) when outlet = 'zaobao' and regexp_matches(path, 'story\\d{8}-\\d+') then 'zaobao:' || regexp_extract(path, 'story\\d{8}-\\d+') "
    "when outlet = 'st' and last <> '' then 'st:' || last else outlet || ':' || path end as key from o"
)
def story_addresses(spark, d):
    """Addresses as three known outlets print them."""
    u = F.col("url")
    for a, b in _HOSTS:
        u = F.replace(u, F.lit(a), F.lit(b))
    a = table(spark, d, "articles").filter("url is not null").select("id", F.concat(u, F.when(F.col("url").contains("zhonglan"), F.concat(F.lit("/story20260101-"), F.col("id").cast("string"))).otherwise("")).alias("url"))
    return a.select("id", T.outlet(F.col("url")).alias("outlet"), T.story_key(F.col("url")).alias("key")).distinct()
