"""Queries of the general operators for large-scale data: snapshot changes and hierarchies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.hierarchy import descendants, record_trees
from ..operators.snapshots import snapshot_changes
from . import table


def p1_found(spark, d):
    return snapshot_changes(table(spark, d, "authority_rows"), table(spark, d, "tte_imports")).select("snapshot", "uid", "change")


def p1_counts(spark, d):
    found = snapshot_changes(table(spark, d, "authority_rows"), table(spark, d, "tte_imports"))
    return found.groupBy("volume", "snapshot", "change").agg(F.count("*").alias("records"))


def _trees(spark, d, paths):
    return record_trees(table(spark, d, "authority_rows"), table(spark, d, "tte_imports"), table(spark, d, "entities"), paths)


def p2_found(spark, d):
    return _trees(spark, d, True).select("tree", F.col("node").alias("uid"), F.col("root").alias("root_uid"))


def p2_paths(spark, d):
    return _trees(spark, d, True).select("tree", F.col("node").alias("uid"), "parent", "root", "depth", F.array_join("path", "/").alias("path"), "cycle")


def p2_descendants(spark, d):
    """Counts and heights of the trees that end in a root, as the SQL has them; :func:`p2_ancestors` has all pairs."""
    trees = _trees(spark, d, True).filter("cycle = 'no'").withColumn("scope", F.col("tree"))
    return descendants(trees).groupBy(F.col("scope").alias("tree"), F.col("ancestor").alias("uid")).agg(F.count("*").alias("descendants"), F.max("distance").alias("height"))


def p2_ancestors(spark, d):
    """The descendants themselves, those below rings included."""
    return descendants(_trees(spark, d, True).withColumn("scope", F.col("tree"))).select(F.col("scope").alias("tree"), "ancestor", F.col("node").alias("uid"), "distance")


QUERIES = {f.__name__: f for f in (p1_found, p1_counts, p2_found, p2_paths, p2_descendants, p2_ancestors)}

_LOADS = """
valid as (select load_id, volume, snapshot from tte_imports where rows_loaded > 0
  qualify row_number() over (partition by filename order by loaded_at desc nulls last, load_id desc) = 1),
days as (select volume, snapshot, row_number() over (partition by volume order by snapshot) as idx from (select distinct volume, snapshot from valid))"""

_CHANGES = f"""
with {_LOADS},
cells as (select v.volume, d.idx, trim(regexp_replace(coalesce(key_uid, ''), ' +', ' ', 'g'), ' ') as uid,
    trim(regexp_replace(coalesce(key_descriptor, ''), ' +', ' ', 'g'), ' ') as a, trim(regexp_replace(coalesce(key_vocabulary, ''), ' +', ' ', 'g'), ' ') as b,
    trim(regexp_replace(coalesce(relationship_type, ''), ' +', ' ', 'g'), ' ') as c, trim(regexp_replace(coalesce(related_uid, ''), ' +', ' ', 'g'), ' ') as e,
    trim(regexp_replace(coalesce(related_descriptor, ''), ' +', ' ', 'g'), ' ') as f, trim(regexp_replace(coalesce(related_vocabulary, ''), ' +', ' ', 'g'), ' ') as g
  from authority_rows r join valid v using (load_id) join days d on d.volume = v.volume and d.snapshot = v.snapshot),
content as (select volume, idx, uid, string_agg(row_text, chr(30) order by row_text) as body
  from (select distinct volume, idx, uid, concat_ws(chr(31), a, b, c, e, f, g) as row_text from cells where uid <> '') group by all),
found as (
  select d.volume, d.snapshot, coalesce(n.uid, o.uid) as uid, n.uid as nu, o.uid as ou, n.body as nb, o.body as ob, d.idx
  from content n full join (select volume, idx + 1 as idx, uid, body from content) o on n.volume = o.volume and n.idx = o.idx and n.uid = o.uid
  join days d on d.volume = coalesce(n.volume, o.volume) and d.idx = coalesce(n.idx, o.idx)
  where d.idx > 1),
changes as (select volume, strftime(snapshot, '%Y-%m-%d') as snapshot, uid, case when ou is null then 'added' when nu is null then 'removed' else 'changed' end as change
  from found where ou is null or nu is null or nb <> ob)"""

_TREES = f"""
with recursive {_LOADS},
lastday as (select v.load_id, v.volume from valid v join (select volume, max(snapshot) as snapshot from valid group by 1) m using (volume, snapshot)),
r as (select volume, trim(key_uid, ' ') as k, upper(trim(relationship_type, ' ')) as t, trim(related_uid, ' ') as u from authority_rows join lastday using (load_id)),
keys as (select distinct volume, k from r where k <> ''),
links as (
  select volume, k as child, u as parent from r where t in ('BT', 'USE', 'CHITOENG', 'MAYTOENG', 'TAMTOENG') and u <> ''
  union select volume, u, k from r where t = 'NT' and u <> ''),
edges as (
  select 'broader' as tree, volume as scope, child, min(parent) as parent from links
  where (volume, child) in (select volume, k from keys) and (volume, parent) in (select volume, k from keys) group by all
  union all select 'canonical', '', uid, canonical_uid from entities where canonical_uid <> '' and canonical_uid <> uid),
walk as (
  select tree, scope, child as node, parent as cur, [child, parent] as seen, child = parent as ring from edges
  union all
  select w.tree, w.scope, w.node, e.parent, list_append(w.seen, e.parent), list_contains(w.seen, e.parent)
  from walk w join edges e on e.tree = w.tree and e.scope = w.scope and e.child = w.cur where not w.ring),
ends as (select *, row_number() over (partition by tree, scope, node order by len(seen) desc) as n from walk),
tops as (select tree, scope, node, ring, seen,
    case when ring then list_min(seen[list_position(seen, cur):len(seen)]) else cur end as root from ends where n = 1)"""

SQL = {
    "p1_found": _CHANGES + "select snapshot, uid, change from changes",
    "p1_counts": _CHANGES + "select volume, snapshot, change, count(*) as records from changes group by all",
    "p2_found": _TREES + "select tree, node as uid, root as root_uid from tops",
    "p2_descendants": _TREES + ", pairs as (select tree, scope, unnest(seen[2:]) as uid, generate_subscripts(seen[2:], 1) as distance from tops where not ring)"
    " select tree, uid, count(*) as descendants, max(distance)::int as height from pairs group by all",
    "p2_paths": _TREES + ", up as (select *, list_position(seen, seen[-1]) as p from tops) select tree, node as uid, seen[2] as parent, root, (case when not ring then len(seen) - 1 when p > 1 then p - 1 end)::int as depth,"
    " case when not ring then array_to_string(list_reverse(seen), '/') when p > 1 then array_to_string(list_reverse(seen[1:p]), '/') end as path, case when not ring then 'no' when p > 1 then 'below' else 'on' end as cycle from up",
    "p2_ancestors": _TREES + ", up as (select tree, scope, node, case when ring then seen[2:list_position(seen, seen[-1])] else seen[2:] end as a from tops) select tree, unnest(a) as ancestor, node as uid, generate_subscripts(a, 1)::int as distance from up",
}
