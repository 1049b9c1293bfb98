"""Queries of the operators on the authority tables, each with the SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import authority, components, evaluation, retrieval, review
from ..operators.snapshots import valid_loads
from . import _sql as S
from . import table
from .general import _LOADS

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, queries: dict | None = None, sqls: dict | None = None):
    def add(f):
        (QUERIES if queries is None else queries)[f.__name__] = f
        if sql:
            (SQL if sqls is None else sqls)[f.__name__] = sql
        return f

    return add


def _mentions(spark, d, name="entity_name"):
    return table(spark, d, "extracted_entities").select("id", F.col("entity_type").alias("kind"), F.col(name).alias("name"))


def _records(spark, d):
    return table(spark, d, "entities").withColumnRenamed("entity_type", "kind")


def _search(n: str, column: str) -> str:
    """CTEs of one search by trigrams: found{n} has id, uid, name, similarity, place."""
    return f"""
names{n} as (select distinct entity_type as kind, {column} as name from extracted_entities union select entity_type, name from entities where is_active),
words{n} as (select distinct kind, name, unnest(list_filter(regexp_split_to_array(lower(name), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> '')) as w from names{n} where name is not null),
g{n} as (select distinct kind, name, substr('  ' || w || ' ', i::bigint, 3) as gram from (select *, unnest(range(1, len(w)::bigint + 2)) as i from words{n})),
sizes{n} as (select kind, name, count(*) as n from g{n} group by all),
l{n} as (select g.* from g{n} g semi join extracted_entities x on x.entity_type = g.kind and x.{column} = g.name), r{n} as (select g.* from g{n} g semi join (select * from entities where is_active) e on e.entity_type = g.kind and e.name = g.name),
shared{n} as (select a.kind, a.name as lname, b.name as rname, count(*) as c from l{n} a join r{n} b on a.kind = b.kind and a.gram = b.gram group by all),
sims{n} as (select s.kind, lname, rname, round(c / (a.n + b.n - c), 6) as similarity from shared{n} s join sizes{n} a on a.kind = s.kind and a.name = lname join sizes{n} b on b.kind = s.kind and b.name = rname),
hits{n} as (select s.*, coalesce(e.canonical_uid, e.uid) as uid, row_number() over (partition by s.kind, lname order by similarity desc, rname, e.uid) as place
  from sims{n} s join entities e on e.entity_type = s.kind and e.name = rname and e.is_active where similarity >= 0.3),
found{n} as (select x.id, h.uid, h.rname as name, h.similarity, h.place::int as place from extracted_entities x join hits{n} h on h.kind = x.entity_type and h.lname = x.{column} where place <= 5 and h.uid in (select uid from entities))"""


@query(f"with {_search('', 'entity_name')} select f.*, c.name as record_name, c.entity_type as record_type, c.language as record_language, cardinality(c.fields)::bigint as record_fields from found f join entities c on c.uid = f.uid")
def trigram_match(spark, d):
    found = retrieval.top_candidates(_mentions(spark, d), _records(spark, d))
    c = table(spark, d, "entities").select("uid", F.col("name").alias("record_name"), F.col("entity_type").alias("record_type"), F.col("language").alias("record_language"), F.size("fields").cast("long").alias("record_fields"))
    return found.join(c, "uid")


@query(f"with {_search('', 'entity_name')}, {_search('2', 'entity_name_en')} select id, uid, max(similarity) as similarity from (select id, uid, similarity from found union all select id, uid, least(similarity, 0.9) from found2) group by all")
def candidates_two_searches(spark, d):
    r = _records(spark, d)
    return retrieval.best_of_searches(retrieval.top_candidates(_mentions(spark, d), r), retrieval.top_candidates(_mentions(spark, d, "entity_name_en"), r))


@query("""
with r as (select load_id, trim(key_uid, ' ') as uid, trim(relationship_type, ' ') as attribute, pos, trim(related_descriptor, ' ') as v from authority_rows
  where coalesce(trim(related_uid, ' '), '') = '' and trim(related_descriptor, ' ') <> ''),
f as (select load_id, uid, attribute, v, min(pos) as pos from r where attribute <> '' and attribute not in ('LDMS URI', 'VIAF URI', 'Wikidata URI', 'Source') group by all)
select load_id, uid, attribute, string_agg(v, ' | ' order by pos, v) as value from f group by all""")
def eav_pivot(spark, d):
    return authority.pivot_attributes(table(spark, d, "authority_rows"))


_CANONICAL = """
r as (select load_id, trim(key_uid, ' ') as uid, trim(key_vocabulary, ' ') as v, pos, upper(trim(relationship_type, ' ')) as t, trim(related_uid, ' ') as u from authority_rows where trim(key_uid, ' ') <> ''),
head as (select load_id, uid, case split_part(arg_min(v, pos), '_', -1) when 'CN' then 'zh' when 'MY' then 'ms' when 'TM' then 'ta' else 'en' end as language from r group by all),
use_ as (select load_id, uid, min(u) as target from r where t = 'USE' and u <> '' and u <> uid group by all), cross_ as (select load_id, uid, min(u) as target from r where t in ('CHITOENG', 'MAYTOENG', 'TAMTOENG') and u <> '' and u <> uid group by all),
canon as (select h.load_id, h.uid, coalesce(s.target, h.uid) as preferred from head h left join use_ s on s.load_id = h.load_id and s.uid = h.uid)"""


@query(f"""with {_CANONICAL} select c.load_id, c.uid, case when p.language <> 'en' then coalesce(x.target, c.preferred) else c.preferred end as canonical
from canon c left join head p on p.load_id = c.load_id and p.uid = c.preferred left join cross_ x on x.load_id = c.load_id and x.uid = c.preferred""")
def canonical_links(spark, d):
    return authority.canonical_targets(table(spark, d, "authority_rows"))


@query(f"""
with {_LOADS}, seen as (select distinct v.volume, d.idx, trim(key_uid, ' ') as uid from authority_rows r join valid v using (load_id) join days d on d.volume = v.volume and d.snapshot = v.snapshot where trim(key_uid, ' ') <> '')
select d.volume, strftime(d.snapshot, '%Y-%m-%d') as snapshot, count(*) as held, count(*) filter (n.uid is null) as missing, sum((n.uid is null)::int) > 0.1 * count(*) as refused
from seen o join days d on d.volume = o.volume and d.idx = o.idx + 1 left join seen n on n.volume = o.volume and n.idx = o.idx + 1 and n.uid = o.uid group by all""")
def snapshot_guard(spark, d):
    return authority.missing_share(table(spark, d, "authority_rows"), valid_loads(table(spark, d, "tte_imports")))


@query("""
select load_id, uid, name, vocabulary from (select load_id, trim(key_uid, ' ') as uid, arg_min(key_descriptor, pos) as name, arg_min(key_vocabulary, pos) as vocabulary from authority_rows group by all)""")
def record_heads(spark, d):
    return authority.records(table(spark, d, "authority_rows")).select("load_id", "uid", "name", "vocabulary")


_STORY = f"""
a as (select id, min(url) as url, min(title) as title, min(coalesce(pubdate, created_at)) as ts from articles group by id),
b as (select *, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\\.', '') as outlet, rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') as path from a),
c as (select *, outlet || ':' || path as key, {S.tight(S.low('title'))} as t from b)"""


@query(f"with {_STORY} select id, outlet, regexp_extract(path, '^/(.*)/[^/]*$', 1) as section, key, t as title_key from c")
def url_parts(spark, d):
    a = table(spark, d, "articles").groupBy("id").agg(F.min("url").alias("url"), F.min("title").alias("title"))
    return T.with_title_key(a, "title", "title_key").select("id", T.outlet(F.col("url")).alias("outlet"), T.section(F.col("url")).alias("section"), T.story_key(F.col("url")).alias("key"), "title_key")


_TWICE = "twice as (select id, url, title, pubdate, created_at, relevant from articles union all select id + 100000000, url || '-again', title, pubdate + interval 1 day, created_at + interval 1 day, relevant from articles where id % 3 = 0)"


def _twice(spark, d):
    """The articles, every third again a day later at another address."""
    a = table(spark, d, "articles").select("id", "url", "title", "pubdate", "created_at", "relevant")
    day = F.expr("interval 1 day")
    again = a.filter("id % 3 = 0").select((F.col("id") + 100000000).alias("id"), F.concat("url", F.lit("-again")).alias("url"), "title", (F.col("pubdate") + day).alias("pubdate"), (F.col("created_at") + day).alias("created_at"), "relevant")
    return a.unionByName(again)


@query(f"""
with recursive {_TWICE}, {_STORY.replace("from articles", "from twice")},
used as (select outlet, t from c where t <> '' group by all having count(distinct coalesce(ts::date, '0001-01-01'::date)) < 3),
close as (select x.id, min(y.id) as to_ from c x join used using (outlet, t) join c y on y.outlet = x.outlet and y.t = x.t and y.id < x.id and abs(epoch_us(x.ts) - epoch_us(y.ts)) <= 2 * 86400000000 where x.t <> '' group by all),
keyed as (select id, min(id) over (partition by key) as to_ from c where key is not null),
ptr as (select c.id, case when k.to_ < c.id then k.to_ else n.to_ end as to_ from c left join keyed k on k.id = c.id left join close n on n.id = c.id),
walk as (select id, id as seen from c union all select w.id, p.to_ from walk w join ptr p on p.id = w.seen where p.to_ is not null)
select id, min(seen) as original from walk group by id""")
def story_copies(spark, d):
    return components.story_copies(_twice(spark, d))


@query("""
select uid, k as field, list_filter([trim(x, ' ') for x in string_split(v, '|')], lambda x: x <> '') as parts from (select uid, unnest(map_keys(fields)) as k, unnest(map_values(fields)) as v from entities)""")
def field_values(spark, d):
    return table(spark, d, "entities").select("uid", F.explode("fields").alias("field", "v")).select("uid", "field", T.values(F.col("v")).alias("parts"))


@query(f"""
with t as (select doc_id, text, {S.sub(S.sub("text", "^" + S.WS + "+|" + S.WS + "+$"), S.ABBREVIATION, "@#@")} as x from documents where text is not null)
select doc_id, len(list_filter(string_split(regexp_replace(x, '([.!?])' || '{S.WS}' || '+([A-Z0-9"''(])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda v: v <> ''))::int as sentences,
  (length(regexp_replace(text, '[^\\x{{2E80}}-\\x{{9FFF}}]', '', 'g')) + ceil((length(text) - length(regexp_replace(text, '[^\\x{{2E80}}-\\x{{9FFF}}]', '', 'g'))) / 4.0))::int as tokens from t""")
def text_measures(spark, d):
    x = table(spark, d, "documents").filter("text is not null")
    return x.select("doc_id", T.sentence_count(F.col("text")).alias("sentences"), T.token_estimate(F.col("text")).alias("tokens"))


_VOTES = """
last_ as (select task, item, labeller, arg_max(label, (coalesce(labelled_at, '1970-01-01'::timestamptz), coalesce(label, ''))) as label from eval_labels where task is not null and item is not null and labeller is not null group by all),
votes as (select task, item, labeller, lower(trim(json_extract_string(label, case task when 'relevance' then '$.relevant' when 'matching' then '$.same' else '$.verdict' end))) as label from last_),
usable as (select * from votes where label in ('true', 'false', 'y', 'n', 'correct', 'partial', 'wrong'))"""


def _votes(spark, d):
    e = table(spark, d, "eval_labels").filter("task is not null and item is not null and labeller is not null")
    last = e.groupBy("task", "item", "labeller").agg(F.max_by("label", F.struct(F.coalesce("labelled_at", F.timestamp_seconds(F.lit(0))), F.coalesce("label", F.lit("")))).alias("label"))
    key = F.when(F.col("task") == "relevance", F.get_json_object("label", "$.relevant")).when(F.col("task") == "matching", F.get_json_object("label", "$.same")).otherwise(F.get_json_object("label", "$.verdict"))
    return last.select("task", "item", "labeller", F.lower(F.trim(key)).alias("label")).filter(F.col("label").isin("true", "false", "y", "n", "correct", "partial", "wrong"))


@query(f"""
with {_VOTES}, p as (select x.task, x.labeller as a, y.labeller as b, x.label as la, y.label as lb, count(*) as n from usable x join usable y on x.task = y.task and x.item = y.item and x.labeller < y.labeller group by all),
t as (select task, a, b, sum(n) as items, sum(case when la = lb then n else 0 end) as agreed from p group by all),
r as (select task, a, b, la as l, sum(n) as ra from p group by all), c as (select task, a, b, lb as l, sum(n) as rb from p group by all),
e as (select task, a, b, sum(ra * rb) as c from r join c using (task, a, b, l) group by all)
select task, a, b, items::bigint as items, agreed::bigint as agreed, case when coalesce(c, 0) / (items * items) < 1 then round((agreed / items - coalesce(c, 0) / (items * items)) / (1 - coalesce(c, 0) / (items * items)), 6) end as kappa from t left join e using (task, a, b)""")
def labeller_kappa(spark, d):
    return evaluation.kappa(_votes(spark, d))


@query(f"with {_VOTES} select task, label, count(*) as votes, count(distinct item) as items, count(distinct labeller) as labellers from usable group by all")
def label_counts(spark, d):
    return _votes(spark, d).groupBy("task", "label").agg(F.count("*").alias("votes"), F.countDistinct("item").alias("items"), F.countDistinct("labeller").alias("labellers"))


@query(f"with {_VOTES} select task, item, labeller, label from (select *, min(label) over w as lo, max(label) over w as hi from usable window w as (partition by task, item)) where lo <> hi")
def label_disagreements(spark, d):
    w = Window.partitionBy("task", "item")
    v = _votes(spark, d).withColumn("lo", F.min("label").over(w)).withColumn("hi", F.max("label").over(w))
    return v.filter("lo <> hi").select("task", "item", "labeller", "label")


_SCORED = f"""{_VOTES}, m as (select distinct c.id, (list_max([x.similarity for x in c.candidates]))::double as score, coalesce(a.source, '') as source from candidate_matches c left join extracted_entities e on e.id = c.extracted_id left join (select id, min(source) as source from articles group by id) a on a.id = e.article_id),
s as (select u.item, u.labeller, (u.label = 'y')::int as label, m.score, m.source from usable u join m on m.id::varchar = u.item where u.task = 'matching' and m.score is not null)"""


def _scored(spark, d):
    """Labellers' verdicts on matches, with the best name likeness that was offered: item, labeller, label, score, source."""
    a = table(spark, d, "articles").groupBy(F.col("id").alias("article_id")).agg(F.min("source").alias("source"))
    e = table(spark, d, "extracted_entities").select(F.col("id").alias("extracted_id"), "article_id")
    m = table(spark, d, "candidate_matches").select("id", "extracted_id", F.array_max(F.transform("candidates", lambda c: c["similarity"])).alias("score"))
    m = m.join(e, "extracted_id", "left").join(a, "article_id", "left").select(F.col("id").cast("string").alias("item"), "score", F.coalesce("source", F.lit("")).alias("source")).distinct()
    v = _votes(spark, d).filter("task = 'matching'").select("item", "labeller", (F.col("label") == "y").cast("int").alias("label"))
    return v.join(m.filter("score is not null"), "item").select("item", "labeller", "label", "score", "source")


@query(f"""
with {_SCORED}, r as (select *, rank() over (partition by source order by score) + (count(*) over (partition by source, score) - 1) / 2 as k from s)
select source, round((sum(k) filter (label = 1) - sum(label) * (sum(label) + 1) / 2) / nullif(sum(label) * (count(*) - sum(label)), 0), 6) as auc from r group by all""")
def rank_auc_by_source(spark, d):
    return evaluation.rank_auc(_scored(spark, d), ["source"])


_CUM = f"""
with {_SCORED}, p as (select score, count(*) as n, sum(label) as pos from s group by all),
c as (select score, sum(n) over (order by score desc) as seen, sum(pos) over (order by score desc) as tp, sum(n) over () as all_n, sum(pos) over () as all_pos from p)"""


@query(_CUM + " select arg_max(score, (round(2 * tp / (seen + all_pos), 6), score)) as threshold, max(round(2 * tp / (seen + all_pos), 6)) as f1 from c")
def best_f1(spark, d):
    return evaluation.best_f1(_scored(spark, d))


@query(_CUM + " select arg_max(round(seen / all_n, 6), score) as passed, max(score) as threshold from c where tp >= 0.95 * all_pos")
def recall_threshold(spark, d):
    return evaluation.recall_threshold(_scored(spark, d))


@query(_CUM + ", q as (select score, round(tp / seen, 6) as precision from c where tp >= 0.8 * all_pos) select arg_max(score, (precision, score)) as threshold, max(precision) as precision from q")
def precision_at_recall(spark, d):
    return evaluation.precision_at_recall(_scored(spark, d), 0.8)


@query(f"""with {_SCORED}, o as (select source, label, row_number() over w as k, sum(label) over (partition by source order by score desc, item || labeller rows unbounded preceding) as tp from s window w as (partition by source order by score desc, item || labeller))
select source, round(avg(tp / k) filter (label = 1), 6) as ap from o group by source""")
def average_precision(spark, d):
    return evaluation.average_precision(_scored(spark, d).withColumn("key", F.concat("item", "labeller")), "key", ["source"])


def _prf_sql(by: str, src: str, t: str) -> str:
    return f"""select {by}sum((score >= {t} and label = 1)::int)::bigint as tp, sum((score >= {t} and label = 0)::int)::bigint as fp, sum((score < {t} and label = 1)::int)::bigint as fn, sum((score < {t} and label = 0)::int)::bigint as tn,
round(sum((score >= {t} and label = 1)::int) / nullif(sum((score >= {t})::int), 0), 6) as precision, round(sum((score >= {t} and label = 1)::int) / nullif(sum(label), 0), 6) as recall,
round(2 * sum((score >= {t} and label = 1)::int) / nullif(sum(label) + sum((score >= {t})::int), 0), 6) as f1, round(sum((score >= {t})::int) / count(*), 6) as flagged from {src}"""


@query(f"with {_SCORED} {_prf_sql('source, ', 's', '0.6')} group by source")
def counts_at_threshold(spark, d):
    return evaluation.prf(_scored(spark, d), F.lit(0.6), ["source"])


@query(f"""with {_SCORED}, x as (select *, case when item::bigint % 2 = 0 then 'dev' else 'held' end as part from s),
p as (select score, count(*) as n, sum(label) as pos from x where part = 'dev' group by all), c as (select score, sum(n) over (order by score desc) as seen, sum(pos) over (order by score desc) as tp, sum(pos) over () as all_pos from p),
t as (select arg_max(score, (round(2 * tp / (seen + all_pos), 6), score)) as threshold from c), y as (select x.*, threshold from x, t)
{_prf_sql('part, threshold, null::varchar as source, ', 'y', 'threshold')} group by part, threshold union all {_prf_sql('part, threshold, source, ', 'y', 'threshold')} group by part, threshold, source""")
def thresholds_carried(spark, d):
    """Fixed on items of even number, applied to all."""
    return evaluation.carried_threshold(_scored(spark, d), F.col("item").cast("long") % 2 == 0, ["source"])


@query(f"""with {_SCORED}, g as (select h.v / 20.0::double as hi, l.v / 20.0::double as lo from range(10, 20) h(v), range(2, 11) l(v))
select hi, lo, round(sum(case when score >= hi and label = 1 or score < lo and label = 0 then 1 else 0 end) / count(*), 6) as agree, count(*) as rows from s, g group by hi, lo""")
def cutoffs(spark, d):
    return evaluation.tune_cutoffs(_scored(spark, d), [v / 20 for v in range(10, 20)], [v / 20 for v in range(2, 11)])


@query(f"with {_SCORED} select floor(score * 10)::int as step, sum(label)::bigint as yes, sum(1 - label)::bigint as no from s group by all")
def verdicts_by_likeness(spark, d):
    s = _scored(spark, d)
    return s.groupBy(F.floor(F.col("score") * 10).cast("int").alias("step")).agg(F.sum("label").alias("yes"), F.sum(1 - F.col("label")).alias("no"))


_STRATA = f"""{_VOTES}, lab as (select item, max(label) as label from (select item, label, count(*) as n, row_number() over (partition by item order by count(*) desc, label) as k from usable where task = 'relevance' group by item, label) where k = 1 group by item),
art as (select id, min(url) as url, coalesce(bool_or(relevant), false) as kept, coalesce(min(source), '') as source from articles group by id), st as (select case when kept then 'kept' else source end as stratum, 1.0 as weight, l.label = 'true' as yes from art left join lab l on l.item = art.url),
g as (select st.stratum, sum(st.weight)::double as size, count(st.yes) as labelled, sum(coalesce(st.yes::int, 0))::bigint as yes from st group by stratum)"""


def _strata(spark, d):
    v = _votes(spark, d).filter("task = 'relevance'").groupBy("item", "label").agg(F.count("*").alias("n"))
    best = v.withColumn("k", F.row_number().over(Window.partitionBy("item").orderBy(F.col("n").desc(), "label"))).filter("k = 1").select(F.col("item").alias("url"), (F.col("label") == "true").alias("yes"))
    a = table(spark, d, "articles").groupBy("id").agg(F.min("url").alias("url"), F.coalesce(F.bool_or("relevant"), F.lit(False)).alias("kept"), F.coalesce(F.min("source"), F.lit("")).alias("source"))
    rows = a.join(best, "url", "left").select(F.when(F.col("kept"), "kept").otherwise(F.col("source")).alias("stratum"), F.lit(1.0).alias("weight"), "yes")
    return evaluation.strata(rows, "stratum", "weight", "yes")


@query(f"with {_STRATA} select * from g")
def strata_totals(spark, d):
    return _strata(spark, d)


@query(f"with {_STRATA}, t as (select sum(size * yes / nullif(labelled, 0)) filter (stratum = 'kept') as found, coalesce(sum(size * yes / nullif(labelled, 0)) filter (stratum <> 'kept'), 0) as missed from g) select round(found, 6) as found, round(missed, 6) as missed, round(found / nullif(found + missed, 0), 6) as recall from t")
def weighted_recall(spark, d):
    t = evaluation.recall_of(_strata(spark, d), F.col("stratum") == "kept")
    return t.select(*[F.round(c, 6).alias(c) for c in ("found", "missed", "recall")])


@query(f"with {_STRATA} select stratum, round(case when labelled > 0 then 1.96 * sqrt((yes / labelled) * (1 - yes / labelled) / labelled) else 1 end, 6) as margin from g")
def margins(spark, d):
    return _strata(spark, d).select("stratum", F.round(evaluation.margin(F.col("yes") / F.nullif(F.col("labelled"), F.lit(0)), F.col("labelled")), 6).alias("margin"))


@query()
def recall_ranges(spark, d):
    return evaluation.recall_range(_strata(spark, d).withColumn("kept", F.col("stratum") == "kept"), "kept")


@query()
def share_ranges(spark, d):
    g = _strata(spark, d)
    return g.select("stratum", "yes", "labelled", evaluation.jeffreys(F.col("yes"), F.col("labelled")).alias("range")).select("stratum", "yes", "labelled", "range.lo", "range.hi")


@query()
def extraction_ranges(spark, d):
    """Labellers' verdicts on an article's names: correct ones, and wrong ones; partial ones count as missed."""
    v = _votes(spark, d).filter("task not in ('matching', 'relevance')").groupBy("item").agg(*[F.sum((F.col("label") == k).cast("int")).alias(c) for k, c in (("correct", "ok"), ("wrong", "bad"), ("partial", "missed"))])
    return evaluation.cluster_range(v.withColumn("group", F.lit("all")).withColumn("weight", F.lit(1.0)), "item")


@query()
def interval_coverage(spark, d):
    g = _strata(spark, d).filter("labelled > 4").orderBy("stratum").collect()
    return evaluation.coverage(spark, [(r["stratum"], int(r["size"]), r["yes"] / r["labelled"], min(r["labelled"], int(r["size"]))) for r in g], 400)


@query(f"with {_SCORED} select source, count(*) as rows_, sum(label)::bigint as yes, round(avg(score), 4) as mean from s group by grouping sets ((), (source))")
def slices(spark, d):
    _scored(spark, d).createOrReplaceTempView("_scored_slices")
    return spark.sql("select source, count(*) as rows_, sum(label) as yes, round(avg(score), 4) as mean from _scored_slices group by grouping sets ((), (source))")


@query("""
with s as (select coalesce(lang, '') || '/' || coalesce(source, '') as stratum, count(*) as size from documents group by all),
e as (select *, size * 200.0::double / sum(size) over () as exact from s), f as (select *, floor(exact) as base, round(exact - floor(exact), 9) as part from e),
r as (select *, 200 - sum(base) over () as rest, row_number() over (order by part desc, stratum) as n from f)
select stratum, size, least(size, base + (n <= rest)::int)::bigint as share from r""")
def allocate_strata(spark, d):
    s = table(spark, d, "documents").groupBy(F.concat(F.coalesce("lang", F.lit("")), F.lit("/"), F.coalesce("source", F.lit(""))).alias("stratum")).agg(F.count("*").alias("size"))
    return evaluation.allocate(s, 200)


@query("""
select doc_id, source, round(size / least(size, 5), 6) as weight from (select *, row_number() over (partition by source order by md5('1:' || doc_id), doc_id) as n, count(*) over (partition by source) as size from documents) where n <= 5""")
def stratified_draw(spark, d):
    return evaluation.draw(table(spark, d, "documents").select("doc_id", "source"), ["source"], "doc_id", 5)


_CHANGES = """
ch as (select distinct id, matched_uid as uid, extracted_id, u.field as field, u.strategy as strategy, u.value as value from (select id, matched_uid, extracted_id, unnest(field_updates) as u from candidate_matches where matched_uid is not null))"""


def _changes(spark, d):
    return review.proposed_changes(table(spark, d, "candidate_matches"))


@query(f"""
with {_CHANGES} select uid, field, strategy, arg_max(value, (length(value), value)) as value, count(distinct lower(trim(value, ' '))) as "values", count(distinct extracted_id) as sources,
  strategy = 'OVERWRITE' and count(distinct lower(trim(value, ' '))) > 1 as conflict from ch group by uid, field, strategy""")
def collapsed_notes(spark, d):
    return review.collapse(_changes(spark, d))


@query(f"""
with {_CHANGES}, held as (select uid, unnest(map_keys(fields)) as field, unnest(map_values(fields)) as held from entities)
select uid, field, case when held is null then 'new' when list_contains([trim(x, ' ') for x in string_split(lower(held), '|')], lower(trim(value, ' '))) then 'same' else 'extra' end as state, count(*) as n
from ch left join held using (uid, field) group by all""")
def field_delta(spark, d):
    return review.field_delta(_changes(spark, d), table(spark, d, "entities"))


@query(f"with {_CHANGES} select distinct uid, field, lower(trim(value, ' ')) as value from ch where (uid, field, lower(trim(value, ' '))) not in (select uid, field, lower(trim(value, ' ')) from ch where strategy in ('APPEND', 'OVERWRITE') and value is not null) and value is not null")
def accounting(spark, d):
    c = _changes(spark, d).filter("value is not null")
    return review.account_for(c, c.filter(F.col("strategy").isin("APPEND", "OVERWRITE")))


@query("select id, extracted_id, matched_uid from candidate_matches where matched_uid is not null and not coalesce(list_contains([c.uid for c in candidates if c.similarity >= 0.5], matched_uid), false)")
def unoffered_matches(spark, d):
    """Matches that were not among the candidates of half a likeness or more."""
    m = table(spark, d, "candidate_matches").filter("matched_uid is not null")
    offered = F.transform(F.filter("candidates", lambda c: c["similarity"] >= 0.5), lambda c: c["uid"])
    return m.filter(~F.coalesce(F.array_contains(offered, F.col("matched_uid")), F.lit(False))).select("id", "extracted_id", "matched_uid")


@query("select distinct id, c.uid as uid, c.similarity as similarity from (select id, unnest(candidates) as c, list_max([x.similarity for x in candidates]) as best from candidate_matches) where best - c.similarity <= 0.25")
def plausible(spark, d):
    m = table(spark, d, "candidate_matches").withColumn("best", F.array_max(F.transform("candidates", lambda c: c["similarity"])))
    return m.select("id", "best", F.explode("candidates").alias("c")).filter("best - c.similarity <= 0.25").select("id", "c.uid", "c.similarity").distinct()


def _list(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in values) + ")"


_RANKED = f"""
c as (select distinct extracted_id, c.uid as uid, c.similarity as similarity from (select extracted_id, unnest(candidates) as c from candidate_matches)),
y as (select e.id, e.entity_type as kind, e.fields as f, coalesce(e.summary, '') || ' ' || coalesce(e.evidence, '') as said, year(coalesce(a.pubdate, e.created_at)) as year
  from extracted_entities e left join (select id, min(pubdate) as pubdate from articles group by id) a on a.id = e.article_id),
p as (select c.extracted_id, c.uid, c.similarity, y.kind, y.f, y.said, y.year, r.fields as rf from c join y on y.id = c.extracted_id join entities r on r.uid = c.uid),
ok as (select * from p where not coalesce(kind = 'PERSON' and regexp_matches(trim(rf['Death Year (yyyy)'], ' '), '^[0-9]{{1,9}}$') and try_cast(trim(rf['Death Year (yyyy)'], ' ') as int) < year - 1 and not list_contains(map_keys(f), 'Death Year (yyyy)')
  and not regexp_matches(said, '(?i)\\b(the late|died|death|passed away|posthumous|obituar|memorial)\\b|逝世|去世|已故|离世'), false)),
k as (select extracted_id, uid, similarity, f, rf, unnest(list_intersect(map_keys(f), map_keys(rf))) as k from ok),
v as (select extracted_id, uid, k, list_filter([{S.tight(S.low('x'))} for x in string_split(f[k], '|')], lambda x: x <> '') as a, list_filter([{S.tight(S.low('x'))} for x in string_split(rf[k], '|')], lambda x: x <> '') as b from k where k in {_list((*retrieval.STRONG, *retrieval.WEAK))}),
w as (select distinct extracted_id, uid, k from (select extracted_id, uid, k, a, unnest(b) as q, b from v) t, (select 1) where list_contains(a, q) or len(list_filter(a, lambda p: len(p) >= 8 and len(q) >= 8 and (contains(p, q) or contains(q, p)))) > 0),
o as (select extracted_id, uid, string_agg(k, ',' order by k) as overlap, least(0.45, sum(case when k in {_list(retrieval.STRONG)} then 0.20 else 0.08 end))::double as bonus from w group by all),
s as (select ok.extracted_id, ok.uid, similarity, coalesce(overlap, '') as overlap, floor((similarity + coalesce(bonus, 0)) * 1000 + 0.500001) / 1000 as score from ok left join o using (extracted_id, uid))"""


@query(f"""with {_RANKED}
select extracted_id, uid, overlap, score, (row_number() over (partition by extracted_id order by score desc, similarity desc, uid))::int as place from s qualify place <= 5""")
def ranked_candidates(spark, d):
    c = table(spark, d, "candidate_matches").select("extracted_id", F.explode("candidates").alias("c")).select("extracted_id", "c.uid", "c.similarity").distinct()
    a = table(spark, d, "articles").groupBy(F.col("id").alias("article_id")).agg(F.min("pubdate").alias("pubdate"))
    e = table(spark, d, "extracted_entities").join(a, "article_id", "left")
    said = F.concat_ws(" ", F.coalesce("summary", F.lit("")), F.coalesce("evidence", F.lit("")))
    m = e.select(F.col("id").alias("extracted_id"), F.col("entity_type").alias("kind"), "fields", said.alias("said"), F.year(F.coalesce("pubdate", "created_at")).alias("year"))
    r = table(spark, d, "entities").select("uid", F.col("fields").alias("record_fields"))
    return retrieval.rank(c.join(m, "extracted_id").join(r, "uid")).withColumn("overlap", F.array_join("overlap", ","))


@query("""
with e as (select *, case when lag(ts) over w is null or epoch_us(ts) - epoch_us(lag(ts) over w) > 3600000000 then 1 else 0 end as n from events window w as (partition by user_id order by ts, event_id)),
l as (select *, sum(n) over (partition by user_id order by ts, event_id rows unbounded preceding) as lease from e)
select user_id, lease::bigint as lease, min(ts) as started, max(ts) as ended, count(*) as events from l group by user_id, lease""")
def lease_sessions(spark, d):
    return review.leases(table(spark, d, "events"))


@query()
def queue_replay(spark, d):
    e = table(spark, d, "events").select((F.col("event_id") % 997).alias("card"), F.col("event_id").alias("seq"), F.col("user_id").alias("user"), F.col("event_type").alias("verb"), "ts")
    return review.replay(e)


@query("select event_id % 997 as card, arg_min(user_id, (ts, event_id)) as user, min(ts) as at from events where event_type = 'purchase' group by all")
def first_decision(spark, d):
    e = table(spark, d, "events").filter("event_type = 'purchase'")
    return e.groupBy((F.col("event_id") % 997).alias("card")).agg(F.min_by("user_id", F.struct("ts", "event_id")).alias("user"), F.min("ts").alias("at"))


@query("""
with days as (select distinct snapshot from tte_imports where snapshot is not null) select a.id, strftime(min(d.snapshot), '%Y-%m-%d') as snapshot
from (select distinct id, pubdate from articles) a left join days d on d.snapshot > a.pubdate::date group by a.id, a.pubdate""")
def next_snapshot(spark, d):
    """Forward as-of join: the few snapshot days (one a delivery) ride along as one sorted array."""
    days = table(spark, d, "tte_imports").filter("snapshot is not null").agg(F.sort_array(F.collect_set("snapshot")).alias("days"))
    a = table(spark, d, "articles").select("id", "pubdate").distinct()
    after = F.filter("days", lambda x: x > F.to_date("pubdate"))
    return a.crossJoin(F.broadcast(days)).select("id", F.date_format(F.when(F.size(after) > 0, F.array_min(after)), "yyyy-MM-dd").alias("snapshot"))


@query("""
with c as (select doc_id, text from documents where text is not null union all select -id, evidence from extracted_entities where evidence is not null),
w as (select doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') as w from c),
g as (select distinct doc_id, array_to_string(w[i:i + n - 1], ' ') as phrase from (select doc_id, w, n, unnest(range(1, len(w)::bigint - n + 2)) as i from w, (values (2), (3), (4), (5), (6)) t(n))),
f as (select distinct uid, array_to_string(list_filter(regexp_split_to_array(lower(name), '[^\\p{L}\\p{N}]+'), lambda x: x <> ''), ' ') as phrase from entities where name is not null)
select uid, count(*) as documents, min(doc_id) as first_doc from g join f using (phrase) where phrase like '% %' group by uid""")
def gazetteer(spark, d):
    """Records' names of 2 to 6 words in documents and evidence (ids below 0). Texts are taken apart into pairs of neighbouring words only; a pair that begins a name brings the name, which is then held against what follows."""
    e = table(spark, d, "extracted_entities").filter("evidence is not null").select((-F.col("id")).alias("doc_id"), F.col("evidence").alias("text"))
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", "text").unionByName(e)
    # exploding an array of one array makes the words a column that is there once
    docs = docs.select("doc_id", F.explode(F.array(T.words(F.col("text")))).alias("w")).filter("size(w) > 1")
    pairs = docs.select("doc_id", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("at")).select("doc_id", F.concat_ws(" ", F.slice("w", F.col("at"), 2)).alias("head"), F.slice("w", F.col("at"), 6).alias("run"))
    names = table(spark, d, "entities").filter("name is not null").select("uid", T.words(F.col("name")).alias("n")).filter("size(n) between 2 and 6").distinct()
    names = names.withColumn("head", F.concat_ws(" ", F.slice("n", 1, 2)))
    hit = pairs.join(names, "head").filter(F.slice("run", F.lit(1), F.size("n")) == F.col("n"))
    return hit.select("uid", "doc_id").distinct().groupBy("uid").agg(F.count("*").alias("documents"), F.min("doc_id").alias("first_doc"))


@query()
def gazetteer_forms(spark, d):
    """As :func:`gazetteer`, with the printed forms of each name and names of 3 to 8 ideographs, which are looked up in runs of characters."""
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", "text")
    said = docs.select("doc_id", F.explode(F.array(T.words(F.col("text")))).alias("w")).select("doc_id", F.explode(T.word_runs("w")).alias("phrase"))
    dense = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[\x{3400}-\x{9FFF}]{3,}"), F.lit(0))).alias("s")).select("doc_id", F.explode(T.dense_runs("s")).alias("phrase"))
    forms = table(spark, d, "entities").filter("name is not null").select("uid", F.explode(T.name_forms(F.col("name"))).alias("form"))
    names = forms.select("uid", F.array_join(T.words(F.col("form")), " ").alias("phrase")).filter(F.col("phrase").contains(" ") | F.col("phrase").rlike(r"^[\x{3400}-\x{9FFF}]{3,8}$")).distinct()
    found = said.unionByName(dense).join(names, "phrase").select("uid", "doc_id").distinct()
    return found.groupBy("uid").agg(F.count("*").alias("documents"), F.min("doc_id").alias("first_doc"))


@query("select coalesce(source, 'all') as source, case when relevant is null then 'waiting' when not relevant then 'declined' when duplicate_of is not null then 'copy' when fetch_attempts >= 3 then 'failed' else 'ready' end as outcome, count(*) as n, count(distinct id) as articles from articles group by all")
def funnel(spark, d):
    a = table(spark, d, "articles")
    outcome = F.when(F.col("relevant").isNull(), "waiting").when(~F.col("relevant"), "declined").when(F.col("duplicate_of").isNotNull(), "copy").when(F.col("fetch_attempts") >= 3, "failed").otherwise("ready")
    return a.groupBy(F.coalesce("source", F.lit("all")).alias("source"), outcome.alias("outcome")).agg(F.count("*").alias("n"), F.countDistinct("id").alias("articles"))


@query("select year(pubdate)::int as year, source, count(*) as n from articles where pubdate is not null and source is not null group by rollup (year(pubdate)::int, source)")
def source_years(spark, d):
    a = table(spark, d, "articles").filter("pubdate is not null and source is not null")
    return a.rollup(F.year("pubdate").alias("year"), "source").agg(F.count("*").alias("n"))


@query("select id, epoch_us(min(created_at)) as created_us from articles where relevant is null group by id")
def unscored(spark, d):
    return table(spark, d, "articles").filter("relevant is null").groupBy("id").agg(F.unix_micros(F.min("created_at")).alias("created_us"))


@query("select id, title from (select *, row_number() over (partition by id order by created_at, fetch_attempts, title) as n from articles where relevant and duplicate_of is null) where n = 1 and fetch_attempts < 3")
def unextracted(spark, d):
    w = Window.partitionBy("id").orderBy("created_at", "fetch_attempts", F.asc_nulls_last("title"))
    a = table(spark, d, "articles").filter("relevant and duplicate_of is null").withColumn("n", F.row_number().over(w))
    return a.filter("n = 1 and fetch_attempts < 3").select("id", "title")


@query("select article_id, count(*) as waiting, string_agg(id::varchar, ',' order by id) as ids from extracted_entities where not resolved group by all")
def unresolved_by_article(spark, d):
    e = table(spark, d, "extracted_entities").filter("not resolved")
    return e.groupBy("article_id").agg(F.count("*").alias("waiting"), F.array_join(F.transform(F.array_sort(F.collect_list("id")), lambda x: x.cast("string")), ",").alias("ids"))


@query("select distinct article_id as id from extracted_entities where article_id is not null except select id from articles where duplicate_of is not null")
def named_originals(spark, d):
    e = table(spark, d, "extracted_entities").filter("article_id is not null").select(F.col("article_id").alias("id"))
    return e.distinct().join(table(spark, d, "articles").filter("duplicate_of is not null").select("id"), "id", "left_anti")


@query("select matched_uid as uid from candidate_matches where matched_uid is not null intersect select uid from entities where not is_active")
def retired_matches(spark, d):
    m = table(spark, d, "candidate_matches").filter("matched_uid is not null").select(F.col("matched_uid").alias("uid"))
    return m.intersect(table(spark, d, "entities").filter("not is_active").select("uid"))


@query(f"with {_STORY} select outlet, t as title, count(distinct ts::date) as days, count(*) as stories from c where t <> '' group by all having count(*) > 1")
def title_days(spark, d):
    a = table(spark, d, "articles").groupBy("id").agg(F.min("url").alias("url"), F.min("title").alias("title"), F.min(F.coalesce("pubdate", "created_at")).alias("ts"))
    a = T.with_title_key(a, "title", "t").select(T.outlet(F.col("url")).alias("outlet"), F.col("t").alias("title"), "ts").filter("title <> ''")
    return a.groupBy("outlet", "title").agg(F.countDistinct(F.to_date("ts")).alias("days"), F.count("*").alias("stories")).filter("stories > 1")


@query("select source, count(*) as texts, count(text) as held, min(length(text)) as shortest, list_sort(list(length(text)) filter (text is not null))[count(text) // 2 + 1] as middle from documents group by all")
def source_lengths(spark, d):
    """The middle is the element at index n/2 of the sorted lengths, found from the histogram so that a source of a third of all rows is no list."""
    x = table(spark, d, "documents").groupBy("source", F.length("text").alias("len")).agg(F.count("*").alias("c"))
    w = Window.partitionBy("source").orderBy("len").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = x.filter("len is not null").withColumn("upto", F.sum("c").over(w)).withColumn("held", F.sum("c").over(Window.partitionBy("source")))
    mid = held.groupBy("source").agg(F.max("held").alias("held"), F.min("len").alias("shortest"), F.min(F.when(F.col("upto") >= F.floor(F.col("held") / 2) + 1, F.col("len"))).alias("middle"))
    total = x.groupBy("source").agg(F.sum("c").alias("texts"))
    return total.join(mid, total["source"].eqNullSafe(mid["source"]), "left").select(total["source"], "texts", F.coalesce("held", F.lit(0)).alias("held"), "shortest", "middle")


@query("select arg_min(id, (created_at, id)) as id, url from articles where url is not null group by url")
def stream_first_urls(spark, d):
    from ..scratch import Scratch
    from ..streaming.ingest import ingest_once

    return ingest_once(spark, f"{d}/articles.parquet", Scratch(spark, "ingest").path("place")).select("id", "url")
