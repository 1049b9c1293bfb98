"""Proposals into cards: one card a record or new name, one note a field, every value with the sources that state it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..scratch import Scratch
from .retrieval import top_candidates

# Languages by what an address contains, groups of cards, what a card shows of a record, and fields never compared.
ADDRESS_LANGUAGES = (("zaobao", "zh"), ("beritaharian", "ms"), ("tamilmurasu", "ta"))
GROUPS = {"PERSON": "people", "ORGANISATION": "organisations", "LEGAL_ACT": "legal acts"}
IDENTIFYING = (
    "Title", "Occupation", "Feature Type", "Affiliations(groupName)", "Parent Organisation", "Awards", "Nationality", "Country", "Street Address",
    "Birth Year (yyyy)", "Death Year (yyyy)", "Description", "SN",
)
SEARCHED = ("Occupation", "Title", "Description", "Feature Type", "Country")
NOT_COMPARED = ("Name", "Name (DisplayName)", "Name (LCNA)", "Name (Chinese)", "Image Link", "DBpedia URI", "SN", "Qualifier")
LINKED = {"Awards": "AWARD", "Affiliations(groupName)": "ORGANISATION", "Parent Organisation": "ORGANISATION", "Founder": "PERSON"}
SUBJECT_TYPES = ("LEGAL_ACT", "EVENT", "AWARD", "PROGRAMME")
EXACT, NEAR_ENOUGH, OMITTED = 0.95, 0.6, "Not returned by the model"


def language_of_address(url: Column) -> Column:
    out = F
    for part, lang in ADDRESS_LANGUAGES:
        out = out.when(url.contains(part), lang)
    return out.otherwise("en")


def group_of(kind: Column) -> Column:
    out = F
    for k, v in GROUPS.items():
        out = out.when(kind == k, v)
    return out.otherwise("everything else")


def card_key(uid: Column, kind: Column, name: Column, english: Column) -> Column:
    """The matched record, else the type and loose English name: what makes two proposals one decision."""
    return F.when(F.coalesce(uid, F.lit("")) != "", F.concat(F.lit("uid:"), uid)).otherwise(F.concat(F.lit("new:"), kind, F.lit(":"), N.loose_name(F.coalesce(F.nullif(english, F.lit("")), name))))


def proposals(matches: DataFrame, mentions: DataFrame, articles: DataFrame) -> DataFrame:
    """pid, card, kind, name, uid, link, day, article of each decision on a mention; decisions given twice are one, rows without a mention or name none."""
    a = articles.groupBy(F.col("id").alias("article")).agg(F.min("url").alias("link"), F.min("pubdate").alias("pubdate"))
    e = mentions.select(F.col("id").alias("extracted_id"), F.col("article_id").alias("article"), F.col("entity_type").alias("kind"), F.col("entity_name").alias("name"), F.col("entity_name_en").alias("en")).filter("name is not null and kind is not null")
    x = matches.select(F.col("id").alias("pid"), "extracted_id", F.col("matched_uid").alias("uid")).distinct().join(e, "extracted_id").join(a, "article", "left")
    return x.select("pid", card_key(F.col("uid"), F.col("kind"), F.col("name"), F.col("en")).alias("card"), "kind", "name", F.nullif("uid", F.lit("")).alias("uid"), "link", F.date_format("pubdate", "yyyy-MM-dd").alias("day"), "article", "extracted_id")


def cards(props: DataFrame) -> DataFrame:
    """card, kind, entity (the longest name), pids (sorted), langs (sorted), newest, top_article, grp, fresh (no record yet): one row a card."""
    longest = F.max_by("name", F.struct(F.length("name"), "name"))
    newest = F.max(F.struct(F.coalesce("day", F.lit("")), F.coalesce("article", F.lit(-1))).alias("m"))
    c = props.groupBy("card").agg(
        F.min("kind").alias("kind"), longest.alias("entity"), F.array_sort(F.collect_set("pid")).alias("pids"), F.array_sort(F.collect_set(language_of_address(F.coalesce("link", F.lit(""))))).alias("langs"),
        F.max("day").alias("newest"), newest.alias("m"), F.max("uid").isNull().alias("fresh"),
    )
    return c.select("card", "kind", "entity", "pids", "langs", "newest", F.col("m.col2").alias("top_article"), group_of(F.col("kind")).alias("grp"), "fresh")


def ordered_positions(df: DataFrame, order: list[Column], name: str = "ord", tmp: Scratch | None = None) -> DataFrame:
    """Adds the place (from 0) of each row in the whole order. Rows are range-partitioned and numbered in their part; the sizes of the parts before, one row a part, are added. ``order`` must tell all rows apart."""
    tmp = tmp or Scratch(df.sparkSession, "positions")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = tmp.keep(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), name)
    sizes = x.groupBy("_part").agg(F.count("*").alias("_size"))
    before = sizes.select("_part", F.coalesce(F.sum("_size").over(Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    x = x.withColumn(name, F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1).join(F.broadcast(before), "_part")
    return x.withColumn(name, (F.col(name) + F.col("_before")).cast("long")).drop("_part", "_before")


def deal_order() -> list[Column]:
    """Latest news first, undated last, then the later article, then the name."""
    return [F.col("newest").desc_nulls_last(), F.col("top_article").desc(), F.col("entity"), F.col("card")]


def pids_of(deck: DataFrame) -> DataFrame:
    return deck.select("card", F.explode("pids").alias("pid"))


def settled(deck: DataFrame, reviews: DataFrame) -> DataFrame:
    """card, settled: whether every proposal has a decision other than unsure. ``reviews``: pid, reviewer, verdict, kept_by ARRAY, one a pid."""
    x = pids_of(deck).join(reviews.filter("verdict <> 'unsure'").select("pid", F.lit(1).alias("_r")).distinct(), "pid", "left")
    return deck.select("card").join(x.groupBy("card").agg((F.count("*") == F.count("_r")).alias("settled")), "card", "left").select("card", F.coalesce("settled", F.lit(True)).alias("settled"))


def open_for(deck: DataFrame, reviews: DataFrame, who: Column) -> DataFrame:
    """The cards with something left for one reviewer: a proposal undecided, or left unsure by another and not kept by this one."""
    x = pids_of(deck).join(reviews, "pid", "left")
    kept = F.coalesce(F.array_contains("kept_by", who), F.lit(False))
    left = F.col("verdict").isNull() | ((F.col("verdict") == "unsure") & (F.col("reviewer") != who) & ~kept)
    return deck.join(x.filter(left).select("card").distinct(), "card", "left_semi")


def queue_for(deck: DataFrame, reviews: DataFrame, claims: DataFrame, who: Column, now: Column, langs: list[str] | None = None, grp: str | None = None, minutes: int = 60) -> DataFrame:
    """What one reviewer may be dealt, next first by ``ordered_positions``'s ``ord``: open, not settled, in a language read, of the group, and held live by nobody; cards of new records come last.

    ``claims``: card, reviewer, claimed_at. Take the first row of ``order by fresh, newest desc nulls last, ord, card`` for the next card.
    """
    held = claims.filter(F.unix_micros("claimed_at") > F.unix_micros(now) - minutes * 60_000_000).select("card").distinct()
    x = open_for(deck, reviews, who).join(settled(deck, reviews).filter("not settled").select("card"), "card", "left_semi").join(held, "card", "left_anti")
    if langs is not None:
        x = x.filter(F.arrays_overlap("langs", F.array(*map(F.lit, langs))))
    return x.filter(F.col("grp") == grp) if grp else x


def updates(matches: DataFrame, props: DataFrame) -> DataFrame:
    """card, field, strategy, value, link: proposed field updates of the cards, decisions given twice once."""
    u = matches.select(F.col("id").alias("pid"), F.explode("field_updates").alias("u")).select("pid", "u.field", "u.strategy", "u.value").distinct().filter("field is not null and value is not null")
    return u.join(props.select("pid", "card", "uid", "link").distinct(), "pid")


def listed_values(ups: DataFrame) -> DataFrame:
    """card, field, key, value, links, sources: each value that is added to a list field, once a key, in its longest wording, with the links that gave it."""
    v = ups.filter("strategy = 'APPEND'").select("card", "field", "link", F.explode(N.values(F.col("value"))).alias("value")).withColumn("key", N.value_key(F.col("value")))
    return v.groupBy("card", "field", "key").agg(F.max_by("value", F.struct(F.length("value"), "value")).alias("value"), F.array_sort(F.collect_set("link")).alias("links")).withColumn("sources", F.size("links").cast("long"))


def credited(listed: DataFrame, stated: DataFrame) -> DataFrame:
    """``listed`` with the links of every article whose own fields state the value, in the same words or the same English: sources are added, never values. ``stated``: card, field, value, link."""
    s = stated.select("card", "field", "link", F.explode(N.news_values(F.col("value"))).alias("said"))
    s = s.select("card", "field", "link", F.explode(F.array_distinct(F.array(N.value_key(F.col("said")), N.value_key(N.english(F.col("said")))))).alias("key")).distinct()
    own = listed.select("card", "field", F.col("key").alias("own"), F.explode(F.array_distinct(F.array(F.col("key"), N.value_key(N.english(F.col("value")))))).alias("key"))
    more = own.join(s, ["card", "field", "key"]).groupBy("card", "field", F.col("own").alias("key")).agg(F.collect_set("link").alias("_more"))
    x = listed.join(more, ["card", "field", "key"], "left").withColumn("links", F.array_sort(F.array_union("links", F.coalesce("_more", F.array().cast("array<string>")))))
    return x.withColumn("sources", F.size("links").cast("long")).drop("_more")


def disputes(listed: DataFrame) -> DataFrame:
    """card, field, family, values: values of one field that are the same but for their years, given by links of which no two give both, so that at least one is wrong."""
    x = listed.withColumn("family", N.family(F.col("value"))).filter(F.size(N.years(F.col("value"))) > 0)
    per = x.groupBy("card", "field", "family").agg(F.array_sort(F.collect_set("key")).alias("values"), F.count("*").alias("n"))
    said = x.select("card", "field", "family", F.explode("links").alias("link")).groupBy("card", "field", "family").agg(F.count("*").alias("given"), F.countDistinct("link").alias("givers"))
    return per.filter("n > 1").join(said.filter("given = givers"), ["card", "field", "family"]).select("card", "field", "family", "values")


def scalar_notes(ups: DataFrame) -> DataFrame:
    """card, field, strategy, value, supporters, conflict of updates that replace a value: the longest wording, its sources, and whether different values were given."""
    x = ups.filter("strategy <> 'APPEND'").withColumn("key", N.value_key(F.col("value")))
    x = x.withColumn("_one", F.when(F.col("strategy") == "REPLACE", "*").when((F.col("field") == "Description") & (F.col("strategy") == "MERGE"), "*").otherwise(F.col("key")))
    return x.groupBy("card", "field", "strategy", "_one").agg(
        F.max_by("value", F.struct(F.length("value"), "value")).alias("value"), F.countDistinct("link").alias("supporters"), (F.countDistinct(F.when(F.trim("value") != "", F.col("key"))) > 1).alias("conflict")
    ).drop("_one")


def delta(news: DataFrame, held: DataFrame) -> DataFrame:
    """key columns of ``news`` (card, uid, field, value) with have, fresh, state: what an article's fields would add to a record, ``new``, ``extra``, ``differs`` or ``same``.

    A list's entry is held if its key or its English form's key is, a street if it stands in one held. A description is one value. Fields that say nothing of use and blank values give no row.
    """
    h = held.select("uid", F.explode("fields").alias("field", "have"))
    x = news.filter(~F.col("field").isin(*NOT_COMPARED)).withColumn("news", F.trim(N.clean_news_value(F.col("field"), F.col("value")))).filter("news <> ''")
    x = x.join(h, ["uid", "field"], "left").withColumn("have", F.trim(F.coalesce("have", F.lit(""))))
    keys = F.transform(N.values(F.col("have")), N.value_key)
    x = x.withColumn("_held", N.values(F.col("have"))).withColumn("_keys", keys)
    street = lambda v: (F.col("field") == "Street Address") & (N.gloss(v) != "") & F.exists("_held", lambda o: N.fold(o).contains(N.fold(N.gloss(v))))
    missing = F.filter(N.values(F.col("news")), lambda v: ~(F.array_contains(F.col("_keys"), N.value_key(v)) | F.array_contains(F.col("_keys"), N.value_key(N.gloss(v))) | street(v)))
    prose = F.col("field") == "Description"
    x = x.withColumn("_missing", missing)
    state = F.when(prose, F.when(F.col("have") == "", "new").when(F.col("have") == F.col("news"), "same").otherwise("differs")).when(F.size("_held") == 0, "new").when(F.size("_missing") == 0, "same").otherwise("extra")
    x = x.withColumn("state", state)
    fresh = F.when(prose, F.when(F.col("state") == "same", "").otherwise(F.col("news"))).otherwise(F.array_join("_missing", N.DELIMITER))
    return x.withColumn("fresh", fresh).drop("_held", "_keys", "_missing")


def derived(deltas: DataFrame, covered: DataFrame) -> DataFrame:
    """Rows of :func:`delta` that add a fact no update proposed (``covered``: card, field), descriptions aside, with the field's value afterwards."""
    x = deltas.filter((F.col("field") != "Description") & F.col("state").isin("new", "extra")).join(covered.select("card", "field").distinct(), ["card", "field"], "left_anti")
    return x.withColumn("result", N.result_of(F.lit("APPEND"), N.values(F.col("have")), F.col("fresh")))


def _own_names(records: DataFrame) -> DataFrame:
    return records.filter("is_active and name is not null and kind is not null").filter("canonical_uid is null or canonical_uid = uid").select("kind", "uid", "name")


def called_records(asked: DataFrame, records: DataFrame) -> DataFrame:
    """kind, name, uid, as_ of :func:`find_records`, without the search for the nearest."""
    live = records.filter("is_active and name is not null and kind is not null")
    own = _own_names(records)
    label = own.select("kind", F.col("uid").alias("_uid"), F.col("name").alias("_label"))
    variants = live.filter("canonical_uid <> uid").select("kind", F.col("canonical_uid").alias("_uid"), "name").join(label, ["kind", "_uid"])
    keyed = own.select("kind", F.col("uid").alias("_uid"), F.col("name").alias("_label"), N.plain(F.col("name")).alias("_k"), F.lit(0).alias("_v")).unionByName(variants.select("kind", "_uid", "_label", N.plain(F.col("name")).alias("_k"), F.lit(1).alias("_v")))
    exact = keyed.groupBy("kind", "_k").agg(F.min(F.struct("_v", "_uid", "_label")).alias("x")).select("kind", "_k", F.col("x._uid").alias("e_uid"), F.col("x._label").alias("e_label"))
    styled = own.withColumn("_h", N.house(F.col("name"))).filter("_h <> ''").groupBy("kind", "_h").agg(F.min(F.struct("uid", "name")).alias("y")).select("kind", "_h", F.col("y.uid").alias("h_uid"), F.col("y.name").alias("h_label"))
    q = asked.select("kind", "name").distinct().withColumn("_k", N.plain(F.col("name"))).withColumn("_h", N.house(F.col("name")))
    q = q.join(exact, ["kind", "_k"], "left").join(styled, ["kind", "_h"], "left")
    as_ = F.when(F.col("e_uid").isNotNull(), F.when(N.plain(F.col("e_label")) != F.col("_k"), F.col("e_label"))).otherwise(F.col("h_label"))
    return q.select("kind", "name", F.coalesce("e_uid", "h_uid").alias("uid"), as_.alias("as_"))


def find_records(asked: DataFrame, records: DataFrame) -> DataFrame:
    """kind, name, uid, as_, nearest, nearest_uid: records of a type by name: the same name, a variant's own name, the same in house style, else the nearest by trigrams.

    ``asked``: kind, name, different; ``records``: uid, kind, name, canonical_uid, is_active. ``as_`` is the record's name where it is written otherwise. Of equal names the smallest uid's counts; a record's own name comes before a variant's.
    """
    q, own = called_records(asked, records), _own_names(records)
    far = q.filter("uid is null").select(F.xxhash64("kind", "name").alias("id"), "kind", "name")
    near = top_candidates(far, own.withColumn("is_active", F.lit(True)).withColumn("canonical_uid", F.col("uid")), 1, NEAR_ENOUGH)
    near = far.join(near.select("id", F.col("name").alias("nearest"), F.col("uid").alias("nearest_uid")), "id").select("kind", "name", "nearest", "nearest_uid")
    return q.join(near, ["kind", "name"], "left")


def linked_values(rows: DataFrame, records: DataFrame, key: str = "id") -> DataFrame:
    """key, field, value (rewritten), wrote: entries of link fields as the records they name are called, a trailing year kept; the original and the English of an entry are both looked up, entries that name no record stay.

    ``rows``: key, field, value. ``wrote`` has ``new=old`` of each entry rewritten, in order.
    """
    kind = F
    for f, k in LINKED.items():
        kind = kind.when(F.col("field") == f, k)
    x = rows.withColumn("kind", kind.otherwise(None)).filter("kind is not null")
    e = x.select(key, "field", "kind", F.posexplode(N.values(F.col("value"))).alias("at", "v")).select("*", F.posexplode(N.tries_for(F.col("v"))).alias("turn", "name"))
    found = called_records(e.select("kind", "name").distinct(), records).filter("uid is not null")
    label = records.filter("is_active").select("kind", "uid", F.col("name").alias("_own"))
    found = found.join(label, ["kind", "uid"]).select("kind", "name", F.coalesce("as_", "_own").alias("called"))
    e = e.join(found, ["kind", "name"], "left").groupBy(key, "field", "at", "v").agg(F.min_by("called", F.when(F.col("called").isNotNull(), F.col("turn"))).alias("called"))
    e = e.withColumn("new", F.when(F.col("called").isNotNull(), N.renamed(F.col("v"), F.col("called"))).otherwise(F.col("v")))
    out = e.groupBy(key, "field").agg(F.array_sort(F.collect_list(F.struct("at", "new", "v"))).alias("p"))
    changed = F.filter("p", lambda s: s["new"] != s["v"])
    return out.select(key, "field", F.array_join(F.transform("p", lambda s: s["new"]), N.DELIMITER).alias("value"), F.array_join(F.transform(changed, lambda s: F.concat(s["new"], F.lit("="), s["v"])), " ; ").alias("wrote"))


def without_held(named: DataFrame, held: DataFrame, key: str = "card") -> DataFrame:
    """key, uid, field, value: entries of list fields in English, once a key, less those the record holds; a field of which nothing is left gives no row. ``named``: key, uid, field, value; ``held``: uid, fields MAP."""
    e = named.select(key, "uid", "field", F.posexplode(N.values(F.col("value"))).alias("at", "v")).withColumn("v", N.english(F.col("v"))).withColumn("k", N.value_key(F.col("v")))
    e = e.groupBy(key, "uid", "field", "k").agg(F.min(F.struct("at", "v")).alias("m"))
    h = held.select("uid", F.explode("fields").alias("field", "have")).select("uid", "field", F.explode(N.values(F.col("have"))).alias("o")).select("uid", "field", N.value_key(F.col("o")).alias("k")).distinct()
    e = e.join(h, ["uid", "field", "k"], "left_anti")
    return e.groupBy(key, "uid", "field").agg(F.array_join(F.transform(F.array_sort(F.collect_list("m")), lambda s: s["v"]), N.DELIMITER).alias("value"))


def omitted_exact(matches: DataFrame, mentions: DataFrame) -> DataFrame:
    """id, uid of decisions that stand only because no answer was given, although the mention's own spelling hit a record at ``EXACT`` or above."""
    best = F.array_max(F.transform("candidates", lambda c: F.struct(F.coalesce(c["similarity"], F.lit(0.0)).alias("similarity"), c["uid"].alias("uid"), c["name"].alias("name"))))
    m = matches.filter(F.col("reasoning").startswith(OMITTED)).select("id", "extracted_id", best.alias("top")).filter(F.col("top.similarity") >= EXACT)
    return m.join(mentions.select(F.col("id").alias("extracted_id")), "extracted_id").select("id", "top.uid").distinct()


def subjects(mentions: DataFrame, articles: DataFrame, counts: DataFrame) -> DataFrame:
    """article_id, id of the mentions an article is about: those given the role; where no mention of it has a role, those named in the title or of a type that is news itself; else the one with most updates (the smaller id of equals).

    ``counts``: id, n. Sums are made by article, so an article of very many mentions is only an aggregation.
    """
    t = articles.groupBy(F.col("id").alias("article_id")).agg(N.fold(F.coalesce(F.min("title"), F.lit(""))).alias("t"))
    e = mentions.filter("article_id is not null").select("id", "article_id", "entity_name", "entity_name_en", "entity_type", "role").join(t, "article_id", "left").join(counts.select("id", "n"), "id", "left")
    named = lambda c: F.coalesce((F.col(c) != "") & F.col("t").contains(N.fold(F.col(c))), F.lit(False))
    e = e.withColumn("_said", F.coalesce(F.col("role") == "subject", F.lit(False))).withColumn("_hit", named("entity_name") | named("entity_name_en") | F.coalesce(F.col("entity_type").isin(*SUBJECT_TYPES), F.lit(False)))
    per = e.groupBy("article_id").agg(F.max(F.coalesce("role", F.lit("")) != "").alias("roles"), F.max("_hit").alias("hits"), F.max_by("id", F.struct(F.coalesce("n", F.lit(0)), -F.col("id"))).alias("most"))
    x = e.join(per, "article_id")
    return x.filter(F.when(F.col("roles"), F.col("_said")).when(F.col("hits"), F.col("_hit")).otherwise(F.col("id") == F.col("most"))).select("article_id", "id").distinct()


def identifying(fields: Column) -> Column:
    """Array of key and value of the fields that say who a record is, the most telling first, blank ones left out."""
    all_ = F.array(*[F.struct(F.lit(k).alias("key"), F.try_element_at(fields, F.lit(k)).alias("value")) for k in IDENTIFYING])
    return F.filter(all_, lambda x: F.coalesce(x["value"], F.lit("")) != "")


def search_rows(records: DataFrame) -> DataFrame:
    """uid, name, kind, identity, gist of the records a reviewer may pick: active and preferred ones; the first telling field in 64 characters, the description's opening in 120."""
    first = F.coalesce(*[F.nullif(F.try_element_at("fields", F.lit(k)), F.lit("")) for k in SEARCHED], F.lit(""))
    gist = N.collapse(F.coalesce(F.try_element_at("fields", F.lit("Description")), F.lit("")))
    return records.filter("is_active and (canonical_uid is null or canonical_uid = '' or canonical_uid = uid)").select("uid", "name", "kind", F.substring(first, 1, 64).alias("identity"), F.substring(gist, 1, 120).alias("gist"))


def variant_names(records: DataFrame) -> DataFrame:
    """uid, names: the different names of the active variants of a record, in the order of their uids, those of the record's own words left out."""
    live = records.filter("is_active")
    own = live.select(F.col("uid").alias("canonical_uid"), F.col("name").alias("_own"))
    v = live.filter("canonical_uid <> uid and canonical_uid <> ''").select("canonical_uid", "uid", F.trim("name").alias("name")).filter("name <> ''").join(own, "canonical_uid", "left")
    v = v.filter(F.col("_own").isNull() | (N.word_bag(F.col("name")) != N.word_bag(F.coalesce("_own", F.lit("")))))
    first = v.groupBy("canonical_uid", "name").agg(F.min("uid").alias("at"))
    return first.groupBy(F.col("canonical_uid").alias("uid")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda s: s["name"]).alias("names"))
