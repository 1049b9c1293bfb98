"""Queries of the classifiers: fitted on the earlier articles, judged on the later."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify, evaluation
from . import _sql as S
from . import table
from .reference import query as _query

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    return _query(sql, QUERIES, SQL)


def _labelled(spark, d):
    a = table(spark, d, "articles").filter("relevant is not null")
    a = a.groupBy("id").agg(F.min("title").alias("title"), F.min("description").alias("description"), F.min(F.col("relevant").cast("int")).cast("double").alias("label"), F.min("created_at").alias("at"))
    return a.withColumn("text", classify.model_text(F.col("title"), F.col("description")))


def _scored(spark, d):
    a = _labelled(spark, d)
    cut = a.agg(F.percentile_approx(F.unix_seconds("at"), 0.7)).first()[0] or 0
    model = classify.fit_text(a.filter(F.unix_seconds("at") < cut).select("id", "text", "label"))
    return classify.text_scores(model, a.filter(F.unix_seconds("at") >= cut).select("id", "text", "label"))


@query()
def relevance_scores(spark, d):
    return _scored(spark, d).select("id", "label", F.round("score", 6).alias("score"))


@query()
def relevance_quality(spark, d):
    s = _scored(spark, d).select(F.col("label").cast("int").alias("label"), "score")
    return evaluation.rank_auc(s).join(evaluation.best_f1(s), F.lit(True))


@query()
def vector_scores(spark, d):
    """The first label of the vectors against all others, fitted on ids not divisible by 5."""
    e = table(spark, d, "embeddings").filter("label is not null")
    e = classify.with_vector(e.select("vec_id", "embedding", (F.col("label") == 0).cast("double").alias("label")), "embedding")
    out = None
    for kind in ("logistic", "mlp", "trees"):
        m = classify.fit_vectors(e.filter("vec_id % 5 <> 0"), kind)
        x = m.transform(e.filter("vec_id % 5 = 0")).select("vec_id", F.lit(kind).alias("model"), "label", "prediction")
        out = x if out is None else out.unionByName(x)
    return out


@query(f"with a as (select id, nullif(trim(min(title), ' '), '') as t, nullif(trim(min(description), ' '), '') as x from articles group by id) select id, {S.tight(chr(39) + chr(39) + ' || coalesce(t, ' + chr(39) + chr(39) + ') || case when t is not null and x is not null then ' + chr(39) + '. ' + chr(39) + ' else ' + chr(39) + chr(39) + ' end || coalesce(x, ' + chr(39) + chr(39) + ')')} as text from a")
def model_texts(spark, d):
    a = table(spark, d, "articles").groupBy("id").agg(F.min("title").alias("title"), F.min("description").alias("description"))
    return a.select("id", classify.model_text(F.col("title"), F.col("description")).alias("text"))


@query("select id, label from (select id, label, row_number() over (partition by label order by md5('1:' || id), id) as k from (select id, min(relevant::int) as label from articles where relevant is not null group by id)) where k <= 8")
def few_shot_picks(spark, d):
    a = table(spark, d, "articles").filter("relevant is not null").groupBy("id").agg(F.min(F.col("relevant").cast("int")).alias("label"))
    return classify.few_shot(a, "id", "label", 8).select("id", "label")


@query("with p as (select distinct id, list_max([c.similarity for c in candidates])::double as a, coalesce(candidates[2].similarity, 0)::double as b, 0.25::double as c from candidate_matches) select id, a as change, round(a * b, 6) as local, round(a * b * (1 - c), 6) as local_kept, round(a * (1 - c), 6) as kept from p where a is not null")
def combined_scores(spark, d):
    """The best and the second candidate's likeness as probabilities."""
    p = table(spark, d, "candidate_matches").select("id", F.array_max(F.transform("candidates", lambda c: c["similarity"])).alias("a"), F.coalesce(F.get("candidates", F.lit(1))["similarity"], F.lit(0.0)).alias("b")).distinct().filter("a is not null")
    x = p.select("id", classify.combined(F.col("a"), F.col("b"), F.lit(0.25)).alias("s")).select("id", "s.*")
    return x.select("id", "change", *[F.round(c, 6).alias(c) for c in ("local", "local_kept", "kept")])


