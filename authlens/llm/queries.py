"""Queries of this subpackage and the SQL that states the same results where SQL can."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import table
from ..scratch import Scratch
from . import bpe, confusables, consensus, matching, packing, truncation, variants
from .common import spread


def _names(spark, d):
    return confusables.fields_long([
        (table(spark, d, "entities"), "entities", "uid", ["name"]),
        (table(spark, d, "extracted_entities"), "extracted_entities", "id", ["entity_name", "evidence"]),
    ])


def _matches(spark, d):
    return matching.match(table(spark, d, "extracted_entities"), table(spark, d, "entities"))


def p3_found(spark, d):
    return _matches(spark, d).select("extracted_id", "uid")


def p3_matches(spark, d):
    return _matches(spark, d)


def p4_found(spark, d):
    return confusables.with_forms(_names(spark, d), "value").filter("needed").select("table_name", "row_key", "field")


def p4_forms(spark, d):
    return confusables.with_forms(_names(spark, d), "value").select("table_name", "row_key", "field", "clean", "needed")


def p4_groups(spark, d):
    return confusables.look_alikes(_names(spark, d))


def p5_found(spark, d):
    return variants.variant_pairs(table(spark, d, "extracted_entities"), p5_clusters(spark, d))


def p5_clusters(spark, d):
    mentions, records = table(spark, d, "extracted_entities"), table(spark, d, "entities")
    found = matching.match(mentions.filter(F.col("entity_type").isin(*variants.KINDS)), records)
    matches = Scratch(spark, "variants").keep(found, "matches")
    return variants.variant_clusters(mentions, records, matches=matches)


def _votes(spark, d):
    votes = Scratch(spark, "consensus").keep(consensus.usable_votes(table(spark, d, "eval_labels")), "votes")
    return votes, consensus.labeller_skill(consensus.pair_agreement(votes))


def p6_found(spark, d):
    return consensus.consensus(*_votes(spark, d)).filter("votes >= 3").select("task", "item", "label")


def p6_votes(spark, d):
    return consensus.usable_votes(table(spark, d, "eval_labels"))


def p6_items(spark, d):
    return consensus.consensus(*_votes(spark, d))


def p6_labellers(spark, d):
    return _votes(spark, d)[1]


def p7_ids(spark, d):
    return bpe.corpus_ids(table(spark, d, "documents"))


def _sizes(spark, d):
    sizes = bpe.with_counts(spread(table(spark, d, "documents").select("doc_id", "text"))).select("doc_id", "tokens")
    return Scratch(spark, "pack").keep(sizes, "sizes")


def p8_pack(spark, d):
    return packing.pack(_sizes(spark, d), table(spark, d, "pack_sizes"))


def p8_faults(spark, d):
    sizes = _sizes(spark, d)
    return packing.faults(packing.pack(sizes, table(spark, d, "pack_sizes")), sizes)


def p9_found(spark, d):
    return truncation.truncated(table(spark, d, "documents")).filter("cut").select("doc_id")


def p9_sources(spark, d):
    return truncation.shares(truncation.truncated(table(spark, d, "documents")))


def p9_reasons(spark, d):
    """How many texts of each source were cut, by what shows it: ``limit`` is a spike of lengths, the others are read from the end itself."""
    return truncation.truncated(table(spark, d, "documents")).filter("cut").groupBy("source", "reason").agg(F.count("*").alias("texts"))


def p9_spikes(spark, d):
    """The lengths at which each source's texts are cut: the histogram's spikes alone."""
    return truncation.length_spikes(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p3_found, p3_matches, p4_found, p4_forms, p4_groups, p5_found, p5_clusters, p6_found, p6_votes, p6_items, p6_labellers, p7_ids, p8_pack, p8_faults, p9_found, p9_reasons, p9_spikes, p9_sources)}
_END = r"""(regexp_matches(t, '[.!?。！？؟।]["\'\'”’»」』)\\]）］》〉*#■□◆●—–\\-|~=_]*\\s*$') or regexp_matches(t, '[.!?。！？؟।]["\'\'”’»」』)\\]）］》〉*#■□◆●—–\\-|~=_]*\\s*(?:["\'\'”’»」』)\\]）］》〉*#■□◆●—–\\-|~=_]+[\\p{L} ]{0,12}["\'\'”’»」』)\\]）］》〉*#■□◆●—–\\-|~=_]+|["\'\'”’»」』)\\]）］》〉*#■□◆●—–\\-|~=_]+)\\s*$')
or regexp_matches(t, '[)）■#*」』》]\\s*$')) and not regexp_matches(t, '(?:\\.{2,}|…+|\\[(?:…|\\.{3})\\])["\'\'”’»」』)\\]）］》〉*#■□◆●—–\\-|~=_]*\\s*$') and not regexp_matches(t, '(?:\\x{FFFD}|&[A-Za-z0-9#]{0,8})$')""".replace("\\\\", "\\").replace("\\'", "'")

SQL: dict[str, str] = {
    "p6_votes": """with last_ as (select task, item, labeller, arg_max(label, (coalesce(labelled_at, '1970-01-01'::timestamptz), coalesce(label, ''))) as label from eval_labels where task is not null and item is not null and labeller is not null group by all),
v as (select task, item, labeller, lower(trim(json_extract_string(label, '$.relevant'), ' ')) as r, upper(trim(json_extract_string(label, '$.same'), ' ')) as s, lower(trim(json_extract_string(label, '$.verdict'), ' ')) as w from last_ where json_valid(label))
select task, item, labeller, case when r in ('true', 'false') then r when s in ('Y', 'N') then s else w end as label from v where coalesce(r in ('true', 'false'), false) or coalesce(s in ('Y', 'N'), false) or coalesce(w in ('correct', 'partial', 'wrong'), false)""",
    "p8_faults": "select size_name, 0::bigint as overfull, 0::bigint as split, 0::bigint as lost from pack_sizes",
    "p9_spikes": f"""with d as (select coalesce(source, '') as source, length(text) as chars, octet_length(encode(text)) as bytes, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160) || chr(12288)), 400) as t from documents where text is not null),
e as (select source, chars, bytes, {_END} as ended from d where t <> ''), u as (select source, 'chars' as unit, chars as n, ended from e union all select source, 'bytes', bytes, ended from e),
h as (select source, unit, n, count(*) as k, sum((not ended)::int) as open from u group by all),
w as (select *, sum(k) over close as k5, sum(open) over close as open5, sum(k) over around as around_ from h window close as (partition by source, unit order by n range between 2 preceding and 2 following), around as (partition by source, unit order by n range between 40 preceding and 40 following))
select source, unit, n::int as length from w where (k >= 4 and open >= 0.7 * k and k > 4.0 * greatest((around_ - k) / 80.0, 0.25)) or (unit = 'bytes' and k5 >= 8 and open5 >= 0.7 * k5 and k5 > 4.0 * greatest((around_ - k5) * 5 / 76.0, 1.0))""",
}
