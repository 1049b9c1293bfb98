"""Queries of the sources: feeds, pages, sitemaps, parts and answers, on documents made from the tables so that what is read is known."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import text as T
from ..operators import cards as C
from ..sources import answers, feeds, pages, parts
from . import _sql as S
from . import table
from .reference import query as _query

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    return _query(sql, QUERIES, SQL)


def _escape(c):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _once(spark, d):
    """One row an article, as first delivered."""
    a = table(spark, d, "articles")
    return a.groupBy("id").agg(*[F.min(c).alias(c) for c in ("url", "title", "description", "category", "source", "pubdate")])


_ONCE = "once as (select id, min(url) as url, min(title) as title, min(description) as description, min(category) as category, min(source) as source, min(pubdate) as pubdate from articles group by id)"


def _documents(spark, d):
    """Feed documents of twenty articles: RSS for even ids of the twenty, Atom for odd."""
    a = _once(spark, d).withColumn("n", F.floor(F.col("id") / 20))
    opt = lambda tag, c: F.coalesce(F.concat(F.lit(f"<{tag}>"), _escape(F.col(c)), F.lit(f"</{tag}>")), F.lit(""))
    mail = F.coalesce(F.concat(F.lit("<pubDate>Mon, "), F.date_format("pubdate", "dd MMM yyyy HH:mm:ss"), F.lit(" +0000</pubDate>")), F.lit(""))
    iso = F.coalesce(F.concat(F.lit("<published>"), F.date_format("pubdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z</published>")), F.lit(""))
    rss = F.concat(F.lit("<item>"), opt("title", "title"), opt("link", "url"), opt("description", "description"), opt("category", "category"), mail, F.lit("</item>"))
    atom = F.concat(F.lit("<entry>"), opt("title", "title"), F.lit('<link href="'), _escape(F.col("url")), F.lit('"/>'), iso, F.lit("</entry>"))
    x = a.filter("url is not null").groupBy("n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", F.when(F.col("n") % 2 == 0, rss).otherwise(atom).alias("x")))), lambda s: s["x"]), "").alias("items"))
    xml = F.when(F.col("n") % 2 == 0, F.concat(F.lit("<rss><channel>"), "items", F.lit("</channel></rss>"))).otherwise(F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), "items", F.lit("</feed>")))
    return x.select(F.col("n").cast("string").alias("feed"), xml.alias("xml"), F.when(F.col("n") % 3 == 0, F.lit("/(arts|local)/")).alias("keep"))


_FED = f"""{_ONCE}, fed as (select floor(id / 20)::bigint::varchar as feed, floor(id / 20)::bigint % 2 = 0 as rss, id, url, coalesce(nullif(trim(title, ' '), ''), url) as title, case when floor(id / 20)::bigint % 2 = 0 then nullif(trim(description, ' '), '') end as description,
  case when floor(id / 20)::bigint % 2 = 0 then nullif(trim(category, ' '), '') end as category, date_trunc('second', pubdate)::timestamp as published, floor(id / 20)::bigint % 3 <> 0 or regexp_matches(url, '/(arts|local)/') as kept from once where url is not null)"""


@query(f"with {_FED} select feed, url, title, description, category, epoch_us(published) as published_us from fed where kept")
def feed_articles(spark, d):
    a = feeds.feed_articles(feeds.parse_feeds(_documents(spark, d)))
    return a.select("feed", "url", "title", "description", "category", F.unix_micros(F.col("published").cast("timestamp")).alias("published_us"))


@query(f"with {_FED} select feed, case when min(rss::int) = 1 then 'rss' else 'atom' end as mode, count(*)::int as found, count(*) filter (kept)::int as kept from fed group by feed")
def feed_modes(spark, d):
    return feeds.parse_feeds(_documents(spark, d)).select("feed", "mode", "found", "kept")


@query(f"with {_FED}, h as (select feed, url in (select url from articles where id % 2 = 0) as held from fed where kept) select feed, count(*) as items, count(*) filter (not held) as fresh, count(*) = count(*) filter (not held) as gap from h group by feed")
def feed_gaps(spark, d):
    return feeds.feed_gaps(feeds.parse_feeds(_documents(spark, d)), table(spark, d, "articles").filter("id % 2 = 0"))


@query(f"with {_FED}, f as (select distinct url from fed where kept and url not in (select url from articles where id % 2 = 0)) select url, (select max(id) from articles where id % 2 = 0) + row_number() over (order by url) as id from f")
def new_article_ids(spark, d):
    a = feeds.feed_articles(feeds.parse_feeds(_documents(spark, d))).select("url")
    return feeds.new_ids(a, table(spark, d, "articles").filter("id % 2 = 0"), [F.col("url")]).select("url", "id")


@query("select id, epoch_us(date_trunc('second', min(pubdate))) as mail, epoch_us(date_trunc('second', min(pubdate))) as iso, epoch_us(date_trunc('second', min(pubdate))) - 8 * 3600000000 as shifted from articles group by id")
def dates_read(spark, d):
    a = _once(spark, d)
    mail = F.concat(F.lit("Tue, "), F.date_format("pubdate", "d MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    us = lambda c: F.unix_micros(feeds.parse_date(c))
    return a.select("id", us(mail).alias("mail"), us(F.date_format("pubdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("iso"), us(F.concat(F.date_format("pubdate", "yyyy-MM-dd HH:mm:ss"), F.lit("+08:00"))).alias("shifted"))


_TEXT = S.tight("text")


@query(f"select doc_id, {_TEXT} as text, case when length(regexp_replace({_TEXT}, '[^\\x{{3400}}-\\x{{9FFF}}]', '', 'g')) * 2 > length({_TEXT}) then 150 else 400 end as least from documents where text is not null")
def page_texts(spark, d):
    """Documents as pages with menus, scripts and a footer around them."""
    x = table(spark, d, "documents").filter("text is not null")
    html = F.concat(F.lit("<html><head><script>var p = '<p>no</p>';</script></head><body><nav><p>Menu</p></nav><div><p>"), _escape(F.col("text")), F.lit("</p><p>Read this subscriber-only article for free!</p></div><footer><p>About</p></footer></body></html>"))
    x = x.select("doc_id", pages.page_text(html).alias("text"))
    return x.select("doc_id", "text", pages.minimum_for(F.col("text")).alias("least"))


_BODY = f"(select doc_id, coalesce(source, '') as source, text, length(text) as n, case when length(regexp_replace(text, '[^\\x{{3400}}-\\x{{9FFF}}]', '', 'g')) * 2 > length(text) then 150 else 400 end as least from documents)"


@query(f"select source, case when coalesce(n, 0) = 0 then 'missing' when n < least then 'short' when source = 'straitline' and n < 800 then 'partial' else 'whole' end as outcome, count(*) as texts, round(avg((n >= least and not (source = 'straitline' and n < 800))::int), 6) as ok from {_BODY} group by all")
def body_outcomes(spark, d):
    x = table(spark, d, "documents").select(F.coalesce("source", F.lit("")).alias("source"), "text")
    e = pages.body_error(F.col("text"), F.when(F.col("source") == "straitline", 800).otherwise(0))
    x = x.withColumn("outcome", F.coalesce(e, F.lit("whole")))
    ok = F.when(F.col("text").isNotNull(), (F.col("outcome") == "whole").cast("int"))
    return x.groupBy("source", "outcome").agg(F.count("*").alias("texts"), F.round(F.avg(ok), 6).alias("ok"))


@query(f"with {_ONCE} select id, {S.tight('title')} as title, {S.tight('description')} as description, strftime(pubdate, '%Y-%m-%d') as published, {S.tight('category')} as category from once")
def page_metadata(spark, d):
    a = _once(spark, d)
    tag = lambda name, c: F.coalesce(F.concat(F.lit(f'<meta {name}" content="'), F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;")), F.lit('">\n')), F.lit(""))
    html = F.concat(tag('property="og:title', F.col("title")), tag('name="description', F.col("description")), tag('property="article:published_time', F.date_format("pubdate", "yyyy-MM-dd'T'HH:mm:ss")), tag('property="article:section', F.col("category")))
    return a.select("id", pages.page_meta(html).alias("m")).select("id", "m.*")


@query(f"with {_ONCE}, s as (select id, replace(string_split(string_split(rtrim(url, '/'), '/')[-1], '?')[1], '-', ' ') as w from once where url is not null) select id, upper(w[1:1]) || w[2:] as title from s")
def slug_titles(spark, d):
    return _once(spark, d).filter("url is not null").select("id", pages.slug_title(F.col("url")).alias("title"))


@query(f"with {_ONCE}, u as (select source, strftime(pubdate, '%Y-%m') as month, url, strftime(pubdate, '%Y-%m-%d') as published, regexp_replace(url, '^https?://[^/]+/', '') as path from once where url is not null and source is not null and pubdate is not null) select source, month, url, published, regexp_replace(path, '/[^/]*$', '') as category from u where regexp_matches(url, '/(arts|life)/')")
def sitemap_rows(spark, d):
    """Sitemaps of one day each, so that none is longer than a day's articles."""
    a = _once(spark, d).filter("url is not null and source is not null and pubdate is not null")
    entry = F.concat(F.lit("<url>\n<loc> "), "url", F.lit("?ai-allowed=1 </loc><lastmod>"), F.date_format("pubdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z</lastmod></url>"))
    m = a.groupBy("source", F.to_date("pubdate").alias("day")).agg(F.array_join(F.collect_list(entry), "\n").alias("xml"))
    return pages.sitemap_rows(m.select("source", F.date_format("day", "yyyy-MM").alias("month"), "xml", F.lit("/(arts|life)/").alias("keep")))


_CUT = f"(select doc_id, {_TEXT} as t, ({_TEXT})[1:280] as cut from documents where text is not null)"
_RFIND = lambda m: f"case when contains(cut, '{m}') then length(cut) - position(reverse('{m}') in reverse(cut)) - {len(m) - 1} + 1 else 0 end"


@query(f"with c as {_CUT}, e as (select *, greatest({_RFIND('. ')}, {_RFIND('。')}, {_RFIND('! ')}, {_RFIND('? ')}) as e from c) select doc_id, case when length(t) <= 280 then t when e - 1 > 140 then trim(cut[1:e], ' ') when contains(cut, ' ') then cut[1:length(cut) - position(' ' in reverse(cut))] || '…' else cut || '…' end as opening from e")
def openings(spark, d):
    return table(spark, d, "documents").filter("text is not null").select("doc_id", pages.opening(F.col("text")).alias("opening"))


@query("with p as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: true) as l, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') as s from documents where text is not null) select doc_id, case when list_sum(list_transform(l, lambda x: length(x))) <= 2 * len(l) then trim(array_to_string(l, ''), ' ') else array_to_string(s, chr(10) || chr(10)) end as body from p")
def index_bodies(spark, d):
    return table(spark, d, "documents").filter("text is not null").select("doc_id", pages.index_body(F.split("text", "\n")).alias("body"))


@query("with m as (select source, min(pubdate) as a, max(pubdate) as b from articles where source is not null and pubdate is not null group by source), s as (select source, unnest(generate_series(date_trunc('month', a)::timestamp, date_trunc('month', b)::timestamp, interval 1 month)) as t from m) select source, strftime(t, '%Y-%m') as month, epoch(t)::bigint as first, epoch(t + interval 1 month)::bigint - 1 as last from s")
def month_spans(spark, d):
    m = table(spark, d, "articles").filter("source is not null and pubdate is not null").groupBy("source").agg(F.min("pubdate").alias("a"), F.max("pubdate").alias("b"))
    x = m.select("source", F.explode(pages.months(F.to_date("a"), F.to_date("b"))).alias("month"))
    return x.select("source", "month", pages.month_bounds(F.col("month")).alias("t")).select("source", "month", "t.first", "t.last")


_SORTED = "row_number() over (partition by source order by pubdate nulls first, url) - 1"


@query(f"with u as (select url, coalesce(source, '') as source, pubdate, created_at, id from articles where url is not null qualify row_number() over (partition by url order by pubdate nulls first, created_at, id) = 1), k as (select *, {_SORTED} as k from u) select url, source, (k // 40 + 1)::int as part, (k % 40)::int as at from k".replace(" as at from", ' as "at" from'))
def archive_parts(spark, d):
    a = table(spark, d, "articles").select("url", F.coalesce("source", F.lit("")).alias("source"), "pubdate", "created_at", "id")
    one = parts.first_of_each(a, [F.col("pubdate").asc_nulls_first(), F.col("created_at"), F.col("id")])
    return parts.with_parts(one, "source", [F.col("pubdate").asc_nulls_first(), F.col("url")], 40).select("url", "source", "part", "at")


@query("select count(*)::bigint as rows, true as fits, true as tight from (select doc_id from documents where text is not null)")
def import_parts(spark, d):
    """Documents in parts of 60,000 bytes: all rows placed, no part too large, and parts as few as the ranges allow."""
    x = table(spark, d, "documents").filter("text is not null").select("doc_id", F.octet_length("text").cast("long").alias("bytes"))
    p = parts.byte_parts(x, "bytes", [F.col("doc_id")], 60_000).groupBy("part").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return p.agg(F.sum("n").alias("rows"), (F.max(F.when(F.col("n") > 1, F.col("bytes"))) <= 60_000).alias("fits"), (F.count("*") <= 2 * F.ceil(F.sum("bytes") / 60_000) + ranges).alias("tight"))


@query("select distinct url from articles where url is not null and url not in (select url from articles where relevant and url is not null)")
def not_yet_held(spark, d):
    a = table(spark, d, "articles").filter("url is not null")
    return parts.not_held(a, a.filter("relevant")).select("url").distinct()


@query("select item, arg_max(label, (labelled_at, labeller, label)) as label from eval_labels where item is not null and label is not null and labelled_at is not null group by item")
def last_answers(spark, d):
    e = table(spark, d, "eval_labels").filter("item is not null and label is not null and labelled_at is not null").select("item", "labelled_at", "labeller", "label")
    return parts.last_line(e, "item", ["labelled_at", "labeller", "label"]).select("item", "label")


@query("select doc_id, ((row_number() over (order by md5('1:' || doc_id), doc_id) - 1) // 100)::int as batch from documents")
def shuffled_batches(spark, d):
    return parts.batched(table(spark, d, "documents").select("doc_id"), "doc_id", 100).select("doc_id", "batch")


@query("select id, json_extract_string(o, '$.n') as name, json_extract_string(o, '$.s') as summary from (select id, to_json({'n': replace(replace(entity_name, chr(10), ' '), chr(13), ' '), 's': summary}) as o from extracted_entities where entity_name is not null)")
def chat_objects(spark, d):
    """Mentions as a chat would answer them: a line before, fences, and a line after."""
    e = table(spark, d, "extracted_entities").filter("entity_name is not null")
    one = F.to_json(F.struct(F.translate("entity_name", "\n\r", "  ").alias("n"), F.col("summary").alias("s")))
    text = F.concat(F.lit("Here it is {:\n```json\n".replace("{", "")), one, F.lit("\n```\nLet me know if {more} is needed."))
    o = answers.json_object(text)
    return e.select("id", o.alias("o")).select("id", F.get_json_object("o", "$.n").alias("name"), F.get_json_object("o", "$.s").alias("summary"))


@query("select case when id % 5 = 0 then 'empty' when id % 5 = 1 then 'prose' when id % 5 = 2 then 'cut off' when id % 5 = 3 then 'no entities' when coalesce(summary, '') = '' or coalesce(evidence, '') = '' then 'lacks summary or evidence' else '' end as fault, count(*) as answers from extracted_entities group by all")
def answer_faults(spark, d):
    e = table(spark, d, "extracted_entities")
    good = F.concat(F.lit('```json\n{"entities": ['), F.to_json(F.struct("summary", "evidence")), F.lit("]}\n```"))
    k = F.col("id") % 5
    text = F.when(k == 0, " ").when(k == 1, "I found two people.").when(k == 2, '{"entities": [{"summary').when(k == 3, '{"note": 1}').otherwise(good)
    return e.select(answers.answer_fault(text).alias("fault")).groupBy("fault").agg(F.count("*").alias("answers"))


@query("with b as (select distinct id from articles), a as (select id, min(title) as reason from articles where relevant and title is not null group by id) select b.id, a.id is not null as relevant, reason from b left join a on a.id = b.id")
def batch_verdicts(spark, d):
    a = table(spark, d, "articles")
    said = a.filter("relevant and title is not null").select("id", F.col("title").alias("reason"))
    return answers.verdicts(a, said.unionByName(spark.createDataFrame([(-5, "not in the batch")], "id long, reason string")))


_ANSWERED = """ans as (select e.article_id, e.entity_name as name, c.id as at_, c.resolution_action as action, c.matched_uid as uid, [x.uid for x in c.candidates] as offered from candidate_matches c join extracted_entities e on e.id = c.extracted_id where e.entity_name is not null)"""


@query(f"""with {_ANSWERED}, nm as (select article_id, entity_name as name, 0 as p, id from extracted_entities where entity_name is not null union all select article_id, entity_name_en, 1, id from extracted_entities where entity_name_en is not null),
fst as (select article_id, name, min(id) as id from nm group by all), ok as (select f.id, a.* from ans a join fst f on f.article_id = a.article_id and f.name = a.name where a.action <> 'CREATE_NEW' and (a.uid is null or coalesce(list_contains(a.offered, a.uid), false))),
one as (select id, min(at_) as at_ from ok group by id), got as (select o.id, first(k.action) as action, first(k.uid) as uid from one o join ok k on k.id = o.id and k.at_ = o.at_ group by o.id)
select e.id, coalesce(g.action, 'CREATE_NEW') as action, g.uid from (select distinct id from extracted_entities) e left join got g on g.id = e.id""")
def answers_settled(spark, d):
    e = table(spark, d, "extracted_entities")
    c = table(spark, d, "candidate_matches").select("extracted_id", F.col("id").alias("at"), F.col("resolution_action").alias("action"), F.col("matched_uid").alias("uid"), F.transform("candidates", lambda x: x["uid"]).alias("offered"))
    a = c.join(e.select(F.col("id").alias("extracted_id"), "article_id", F.col("entity_name").alias("name")).filter("name is not null"), "extracted_id")
    return answers.first_answers(a, e)


@query("select id, len(map_keys(fields))::int as pairs, coalesce(array_to_string(list_sort(map_keys(fields)), ','), '') as keys from extracted_entities where fields is not null and cardinality(fields) > 0 and len(list_filter(map_keys(fields), lambda k: not regexp_matches(k, '^[A-Z]'))) = 0 and len(list_filter(map_values(fields), lambda v: v is null or v <> trim(v, ' ') or v = '' or regexp_matches(v, '[·:]'))) = 0")
def field_lines(spark, d):
    """Fields written on one line and read back: those whose names begin with a capital and whose values hold no sign of the line's own."""
    e = table(spark, d, "extracted_entities").filter(F.col("fields").isNotNull() & (F.size("fields") > 0)).withColumn("e", F.sort_array(F.map_entries("fields")))
    fine = F.forall("e", lambda x: x["key"].rlike("^[A-Z]") & x["value"].isNotNull() & (x["value"] == F.trim(x["value"])) & (x["value"] != "") & ~x["value"].rlike("[·:]"))
    line = F.array_join(F.transform("e", lambda x: F.concat(x["key"], F.lit(": "), x["value"])), " · ")
    got = e.filter(fine).select("id", answers.split_fields(line).alias("p"))
    return got.select("id", F.size("p").alias("pairs"), F.array_join(F.array_sort(F.transform("p", lambda x: x["key"])), ",").alias("keys"))


@query("with l as (select doc_id, coalesce(list_filter(list_transform(regexp_split_to_array(text, '\\r\\n|\\r|\\n'), lambda x: trim(x, ' ')), lambda x: x <> '')[1], '') as f from documents where text is not null), b as (select doc_id, regexp_replace(f, '^[ \"“”'']+|[ \"“”'']+$', '', 'g') as b from l) select doc_id, case when length(b) <= 140 then b else '' end as line from b")
def greeting_lines(spark, d):
    return table(spark, d, "documents").filter("text is not null").select("doc_id", answers.one_line(F.col("text")).alias("line"))


@query("select distinct id, case when url like '%zhonglan%' then 'zh' when url like '%merdu%' then 'ms' when url like '%kuralmedai%' then 'ta' else 'en' end as lang from articles where url is not null")
def address_languages(spark, d):
    from .desk import _hosted

    return table(spark, d, "articles").filter("url is not null").select("id", C.language_of_address(_hosted(F.col("url"))).alias("lang")).distinct()


@query("select id, sha256(coalesce(title, '') || coalesce(description, '')) as digest, nullif(trim(regexp_replace('<div>' || description || '</div>', '<[^>]*>', '', 'g'), ' '), '') as bare from articles where title is not null")
def digests(spark, d):
    a = table(spark, d, "articles").filter("title is not null")
    return a.select("id", F.sha2(F.concat(F.coalesce("title", F.lit("")), F.coalesce("description", F.lit(""))), 256).alias("digest"), T.strip_tags(F.concat(F.lit("<div>"), "description", F.lit("</div>"))).alias("bare"))


@query(f"select id, trim(regexp_replace({S.tight(S.low('entity_name'))}, '([\\x{{2E80}}-\\x{{9FFF}}])', ' \\1 ', 'g'), ' ') as tokens from extracted_entities where entity_name is not null")
def spaced_tokens(spark, d):
    """Names as a classifier's text: ideographs each a token."""
    return table(spark, d, "extracted_entities").filter("entity_name is not null").select("id", F.trim(F.regexp_replace(N.collapse(N.fold(F.col("entity_name"))), r"([\x{2E80}-\x{9FFF}])", " $1 ")).alias("tokens"))
