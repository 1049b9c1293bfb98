"""Queries on the authority file's upkeep: exports, fields, replacement by a new snapshot, requeueing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fields as FL
from ..operators import authority, replacement, retrieval
from ..operators.snapshots import valid_loads
from . import _sql as S
from . import table
from .general import _LOADS
from .reference import _CANONICAL, _mentions, _records, _search
from .reference import query as _query

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    return _query(sql, QUERIES, SQL)


@query("""
with f as (select load_id, filename, upper(regexp_extract(filename, '(?i)TTE-([A-Z_]+)_FULL_([0-9]{8})\\.csv$', 1)) as vocab, regexp_extract(filename, '(?i)TTE-([A-Z_]+)_FULL_([0-9]{8})\\.csv$', 2) as day from tte_imports)
select load_id, case vocab when 'PEOPLE' then 'PERSON' when 'ORGANISATIONS' then 'ORGANISATION' when 'GEOBUILDINGS' then 'FACILITY' when 'GEOGRAPHICS' then 'LOCATION' when 'EVENTS' then 'EVENT' when 'HISTORICAL_EVENTS' then 'EVENT'
when 'AWARDS' then 'AWARD' when 'PROGRAMMES' then 'PROGRAMME' when 'LEGALACTS' then 'LEGAL_ACT' end as entity_type, day[1:4] || '-' || day[5:6] || '-' || day[7:8] as snapshot from f where vocab <> ''""")
def export_files(spark, d):
    f = table(spark, d, "tte_imports").select("load_id", authority.file_parts(F.col("filename")).alias("p")).filter("p is not null")
    return f.select("load_id", "p.entity_type", F.date_format("p.snapshot", "yyyy-MM-dd").alias("snapshot"))


@query("select filename, count(*) as loads, arg_max(checksum, (loaded_at, load_id)) as checksum, count(distinct checksum) as contents, count(*) filter (rows_loaded = 0) as again from tte_imports group by filename")
def import_ledger(spark, d):
    """A file's loads and the content last loaded; a later load of equal content loads nothing."""
    t = table(spark, d, "tte_imports")
    return t.groupBy("filename").agg(F.count("*").alias("loads"), F.max_by("checksum", F.struct("loaded_at", "load_id")).alias("checksum"), F.countDistinct("checksum").alias("contents"), F.count(F.when(F.col("rows_loaded") == 0, 1)).alias("again"))


@query("select uid, case upper(split_part(vocabulary, '_', -1)) when 'CN' then 'zh' when 'MY' then 'ms' when 'TM' then 'ta' else 'en' end as language, regexp_replace(vocabulary, '_(CN|MY|TM)$', '') as family from entities where vocabulary is not null")
def vocabulary_languages(spark, d):
    v = F.col("vocabulary")
    return table(spark, d, "entities").filter("vocabulary is not null").select("uid", authority.language_of(v).alias("language"), authority.family_of(v).alias("family"))


_LIMITS = " union all ".join(f"select '{k}' as kind, '{f}' as stored" for k, fs in FL.FIELDS.items() for f in fs)
_BARE = lambda c: f"regexp_replace(lower(regexp_replace({c}, '\\s*\\([^)]*\\)', '', 'g')), '[^a-z]', '', 'g')"
_FIELD = f"""
names as ({_LIMITS}), f as (select id, entity_type as kind, unnest(map_entries(fields)) as e from extracted_entities),
x as (select f.id, f.kind, f.e.key as key, f.e.value as value, n.stored from f left join names n on n.kind = f.kind and {_BARE('n.stored')} = {_BARE('f.e.key')})"""


@query(f"with {_FIELD} select id, key, stored from x")
def stored_field_names(spark, d):
    f = table(spark, d, "extracted_entities").select("id", F.col("entity_type").alias("kind"), F.explode("fields").alias("key", "value"))
    return FL.with_stored(f, "kind", "key").select("id", "key", "stored")


_ALLOWED = f"""
allowed as (select distinct field, unnest({S.parts('v')}) as term from (select unnest(map_keys(fields)) as field, unnest(map_values(fields)) as v from entities) where field in ('Occupation', 'Nationality', 'Title', 'Feature Type', 'Category'))"""


def _allowed(spark, d):
    from ..functions.names import values

    f = table(spark, d, "entities").select(F.explode("fields").alias("field", "v")).filter(F.col("field").isin(*FL.CONSTRAINED))
    return f.select("field", F.explode(values(F.col("v"))).alias("term")).distinct()


@query(f"""with {_FIELD}, {_ALLOWED}, closed as (select field, list(term) as terms from allowed group by field),
y as (select id, key, stored, value, case when terms is not null then nullif(array_to_string(list_filter({S.parts('value')}, lambda t: list_contains(terms, t)), ' | '), '') else case when stored is not null then value end end as clean from x left join closed on closed.field = x.stored),
k as (select id, stored, arg_max(clean, key) as clean from y where clean is not null group by all), l as (select id, case when stored is null then key else stored || '=' || coalesce(value, '') end as lost from y where stored is null or clean is null),
a as (select id, string_agg(stored || '=' || clean, ' ; ' order by stored) as kept from k group by id), b as (select id, string_agg(lost, ' ; ' order by lost) as dropped from l group by id)
select e.id, coalesce(kept, '') as kept, coalesce(dropped, '') as dropped from extracted_entities e left join a on a.id = e.id left join b on b.id = e.id""")
def fields_cleaned(spark, d):
    """Mentions' fields under their stored names; closed lists are the terms the records use."""
    e = table(spark, d, "extracted_entities").select("id", F.col("entity_type").alias("kind"), "fields")
    out = FL.clean_fields(e, _allowed(spark, d))
    kept = F.transform(F.array_sort(F.map_entries("kept")), lambda x: F.concat(x["key"], F.lit("="), x["value"]))
    return out.select("id", F.array_join(kept, " ; ").alias("kept"), F.array_join("dropped", " ; ").alias("dropped"))


def _last_two(spark, d):
    """Records of each volume's last snapshot and of the one before, the latter as if stored: volume in ``scope``."""
    rows, loads = table(spark, d, "authority_rows"), valid_loads(table(spark, d, "tte_imports"))
    last = loads.filter("next_snapshot is null").select("load_id", "volume", "idx")
    before = loads.join(last.select("volume", (F.col("idx") - 1).alias("idx")), ["volume", "idx"]).select("load_id", "volume")
    recs = replacement.snapshot_records(rows)
    new = recs.join(F.broadcast(last.select("load_id", "volume")), "load_id").drop("load_id")
    stored = recs.join(F.broadcast(before), "load_id").drop("load_id").withColumn("is_active", F.lit(True))
    return new, stored


_TWO = f"""{_LOADS}, {_CANONICAL},
nm as (select load_id, trim(key_uid, ' ') as uid, arg_min(trim(key_descriptor, ' '), pos) as name, arg_min(coalesce(trim(key_vocabulary, ' '), ''), pos) as vocabulary from authority_rows where trim(key_uid, ' ') <> '' and trim(key_descriptor, ' ') <> '' group by all),
attr as (select load_id, trim(key_uid, ' ') as uid, trim(relationship_type, ' ') as attribute, trim(related_descriptor, ' ') as v, min(pos) as pos from authority_rows where coalesce(trim(related_uid, ' '), '') = '' and trim(related_descriptor, ' ') <> '' and trim(key_descriptor, ' ') <> ''
  and trim(relationship_type, ' ') not in ('', 'LDMS URI', 'VIAF URI', 'Wikidata URI', 'Source') group by all),
av as (select load_id, uid, attribute, string_agg(v, ' | ' order by pos, v) as value from attr group by all), fl as (select load_id, uid, string_agg(attribute || '=' || value, chr(1) order by attribute) as fields from av group by all),
rec as (select n.load_id, n.uid, n.name, n.vocabulary, case upper(split_part(n.vocabulary, '_', -1)) when 'CN' then 'zh' when 'MY' then 'ms' when 'TM' then 'ta' else 'en' end as language,
  nullif(case when p.language <> 'en' then coalesce(x.target, c.preferred) else c.preferred end, n.uid) as canonical_uid, coalesce(fl.fields, '') as fields
  from nm n left join canon c on c.load_id = n.load_id and c.uid = n.uid left join head p on p.load_id = c.load_id and p.uid = c.preferred left join cross_ x on x.load_id = c.load_id and x.uid = c.preferred left join fl on fl.load_id = n.load_id and fl.uid = n.uid),
place as (select v.load_id, v.volume, d.idx, max(d.idx) over (partition by v.volume) as top from valid v join days d on d.volume = v.volume and d.snapshot = v.snapshot),
new as (select p.volume, r.* from rec r join place p using (load_id) where idx = top), old as (select p.volume, r.* from rec r join place p using (load_id) where idx = top - 1)"""


@query(f"with {_TWO} select n.uid, n.volume from new n left join old o on o.uid = n.uid where o.uid is null or o.name is distinct from n.name or o.vocabulary is distinct from n.vocabulary or o.language is distinct from n.language or o.canonical_uid is distinct from n.canonical_uid or o.fields is distinct from n.fields")
def records_to_write(spark, d):
    new, stored = _last_two(spark, d)
    return replacement.changed(new, stored).select("uid", "volume")


_GONE = f"{_TWO}, gone as (select o.* from old o where o.uid not in (select uid from new) and regexp_replace(o.vocabulary, '_(CN|MY|TM)$', '') in (select regexp_replace(vocabulary, '_(CN|MY|TM)$', '') from new))"


@query(f"with {_GONE} select g.uid, case when g.uid in (select matched_uid from candidate_matches where matched_uid is not null) or g.uid in (select canonical_uid from new where canonical_uid is not null) then 'keep' else 'delete' end as action from gone g")
def records_to_remove(spark, d):
    new, stored = _last_two(spark, d)
    gone = replacement.dropped(new, stored)
    return replacement.removal(gone, new, stored, table(spark, d, "candidate_matches").select(F.col("matched_uid").alias("uid")))


@query(f"with {_GONE}, a as (select count(*) as active from old where regexp_replace(vocabulary, '_(CN|MY|TM)$', '') in (select regexp_replace(vocabulary, '_(CN|MY|TM)$', '') from new)) select active, (select count(*) from gone) as silent, (select count(*) from gone) > 0.1 * active as refused from a")
def replacement_refused(spark, d):
    new, stored = _last_two(spark, d)
    return replacement.refusal(new, stored, replacement.dropped(new, stored))


@query(f"with {_TWO}, fresh as (select uid from new where uid not in (select uid from old)) select uid, 1 as pass, case when canonical_uid in (select uid from fresh) then null else canonical_uid end as pointer from new union all select uid, 2, canonical_uid from new where canonical_uid in (select uid from fresh)")
def write_passes(spark, d):
    new, stored = _last_two(spark, d)
    return replacement.passes(new, stored)


_IMPORT = "imp as (select uid, case when not is_active then 'retired' when first_seen > (select max(last_seen) from entities) - interval 6 hour then 'added' end as state from entities)"


@query(f"with {_IMPORT} select * from imp where state is not null")
def newest_import(spark, d):
    return replacement.last_import(table(spark, d, "entities"))


def _stale(spark, d):
    e = table(spark, d, "entities")
    found = retrieval.top_candidates(_mentions(spark, d), _records(spark, d)).select("id", "uid")
    matches = table(spark, d, "candidate_matches").filter("matched_uid is not null").select(F.col("extracted_id").alias("id"), F.col("matched_uid").alias("uid")).distinct()
    return replacement.stale(_mentions(spark, d), matches, found, replacement.last_import(e))


_STALE = f"""{_search('', 'entity_name')}, {_IMPORT}, ret as (select distinct extracted_id as id from candidate_matches where matched_uid in (select uid from imp where state = 'retired')),
n as (select distinct id from found where uid in (select uid from imp where state = 'added')), stale as (select id, 'matched record retired' as why from ret union all select id, 'a new record is now a candidate' from n where id not in (select id from ret))"""


@query(f"with {_STALE} select s.* from stale s where id in (select id from extracted_entities)")
def stale_decisions(spark, d):
    return _stale(spark, d)


@query(f"with {_STALE} select resolved, count(*) as mentions, (select count(*) from candidate_matches where extracted_id not in (select id from stale)) as decisions from (select case when id in (select id from stale) then false else resolved end as resolved from extracted_entities) group by resolved")
def requeued_counts(spark, d):
    m, c = replacement.requeued(table(spark, d, "extracted_entities"), table(spark, d, "candidate_matches"), _stale(spark, d))
    return m.groupBy("resolved").agg(F.count("*").alias("mentions")).join(F.broadcast(c.agg(F.count("*").alias("decisions"))), F.lit(True))
