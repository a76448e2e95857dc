"""Towers, attention, pair scores, fitted models, metrics and model selection."""

from __future__ import annotations

from functools import reduce
from math import ceil

import numpy as np
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reclake.functions import vectors as V
from reclake.functions.features import hash_unit
from reclake.operators import itemindex as I
from reclake.operators import metrics as Q
from reclake.operators import models as M
from reclake.operators import ranking as K
from reclake.operators import scoring as S
from reclake.operators import selection as R
from reclake.operators.sampling import negatives_per_positive
from reclake.operators.splits import temporal_split, union_splits
from reclake.plans.evaluation import evaluate, fitted_bundle, summary_of
from reclake.session import materialize_packed as materialize
from reclake.workloads.learning import decoy_rows
from reclake.workloads.registry import query, rounded
from reclake.workloads.tables import MODELS, Tables


DIM, OUT, GENRES = 64, 16, 10
PROBED = 0.7


def rule_layer(outputs: int, inputs: int, salt: int) -> S.Layer:
    """Weights of a tower layer, set by a rule so that SQL can state them too."""
    i, j = np.arange(outputs)[:, None], np.arange(inputs)[None, :]
    i1 = np.arange(outputs)
    return {
        "weight": ((i * 7 + j * 13 + salt) % 11 - 5) / 20.0,
        "bias": ((i1 + salt) % 5 - 2) / 10.0,
        "mean": ((i1 * 3 + salt) % 7) / 20.0,
        "var": 1 + (i1 % 3) / 4.0,
        "gamma": 1 + (i1 % 2) / 10.0,
        "beta": (i1 % 4) / 20.0,
    }


def rule_weights(size: int, salt: int) -> list[float]:
    return [((j * 13 + salt) % 11 - 5) / 20.0 for j in range(size)]


def layer_sql(vector: str, outputs: int, inputs: int, salt: int) -> str:
    """SQL of one layer of :func:`rule_layer` over a list."""
    linear = (
        f"list_sum(list_transform(range({inputs}), lambda j: {vector}[j + 1]::double "
        f"* (((i * 7 + j * 13 + {salt}) % 11 - 5) / 20.0::double)))"
    )
    return (
        f"list_transform(range({outputs}), lambda i: greatest(0.0::double, ({linear} + ((i + {salt}) % 5 - 2) / 10.0::double "
        f"- ((i * 3 + {salt}) % 7) / 20.0::double) / sqrt(1 + (i % 3) / 4.0::double + 1e-5::double) "
        f"* (1 + (i % 2) / 10.0::double) + (i % 4) / 20.0::double))"
    )


def dot_sql(vector: str, inputs: int, salt: int) -> str:
    return (
        f"list_sum(list_transform(range({inputs}), lambda j: {vector}[j + 1]::double "
        f"* (((j * 13 + {salt}) % 11 - 5) / 20.0::double)))"
    )


ITEM_NET = {
    "item": rule_layer(OUT, DIM, 1),
    "category": rule_layer(OUT, GENRES, 2),
    "attention": {
        "category": (rule_weights(OUT, 3), 0.1), "text": (rule_weights(DIM, 4), 0.0), "image": (rule_weights(DIM, 5), -0.1),
    },
    "content": [rule_layer(24, OUT + 2 * DIM, 6), rule_layer(12, 24, 7)],
    "final": rule_layer(OUT, OUT + 12, 8),
}
RATING_HEAD = (rule_weights(OUT, 9), 0.05)
INTERACTION_HEAD = (rule_weights(OUT, 10), -0.05)

# Users are the vectors themselves; the genres of an item mark its label; its image is the vector, negated.
_USER_SQL = f"select vec_id as user_id, {layer_sql('embedding', OUT, DIM, 0)} as user_vector from embeddings"
_ITEM_SQL = f"""
    select vec_id as item_id, label as item_idx, w as weights, {layer_sql(
        f"list_concat({layer_sql('embedding', OUT, DIM, 1)}, c2)", OUT, OUT + 12, 8)} as item_vector
    from (select *, {layer_sql('c1', 12, 24, 7)} as c2 from (select *, {layer_sql(
        "list_concat(list_transform(cat, lambda x: x * w[1]), list_transform(embedding, lambda x: x::double * w[2]), "
        "list_transform(embedding, lambda x: -x::double * w[3]))", 24, OUT + 2 * DIM, 6)} as c1
      from (select *, list_transform(e, lambda x: x / list_sum(e)) as w from (
        select *, [exp({dot_sql('cat', OUT, 3)} + 0.1::double), exp({dot_sql('embedding', DIM, 4)}),
          exp(-({dot_sql('embedding', DIM, 5)}) - 0.1::double)] as e
        from (select vec_id, label, embedding, {layer_sql(
            f"list_transform(range({GENRES}), lambda g: case when g = label then 1 else 0 end)", OUT, GENRES, 2)} as cat
          from embeddings)))))"""
_SIGMOID = "1.0::double / (1.0::double + exp(-({})))"


def _head_sql(head_salt: int, bias: float) -> str:
    product = f"list_transform(range({OUT}), lambda n: user_vector[n + 1] * item_vector[n + 1])"
    return _SIGMOID.format(f"{dot_sql(f'({product})', OUT, head_salt)} + {bias}::double")


def user_vectors(t: Tables, only: DataFrame | None = None) -> DataFrame:
    """Tower vectors of all users, or of those in ``only``; the tower runs for no others."""
    users = t.vectors.select(F.col("item_id").alias("user_id"), F.col("text_emb").alias("emb"))
    return S.score_user_tower(users if only is None else users.join(only, "user_id", "left_semi"), rule_layer(OUT, DIM, 0))


def item_vectors(t: Tables, only: DataFrame | None = None) -> DataFrame:
    vector = F.col("embedding")
    places = F.array(*[(F.col("label") == place).cast("int") for place in range(GENRES)])
    rows = t.read("embeddings") if only is None else t.read("embeddings").join(only, F.col("vec_id") == only["item_id"], "left_semi")
    items = rows.select(
        F.col("vec_id").alias("item_id"), F.col("label").cast("bigint").alias("item_idx"), vector.alias("emb"),
        places.alias("genres_multihot"), vector.alias("text_emb"), F.transform(vector, lambda x: -x).alias("img_emb"),
    )
    return S.score_item_tower(items, ITEM_NET)


def _long(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(key, F.posexplode(vector).alias("pos", "x")).select(
        key, F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("x")
    )


def _long_sql(key: str, vector: str, source: str) -> str:
    return f"""select {key}, pos, round(v[pos + 1], 6) as x from (
      select {key}, v, unnest(range(len(v))) as pos from (select {key}, {vector} as v from ({source})))"""


@query("m1_rating_model")
def _(t: Tables) -> DataFrame:
    parts = t.feature_splits()
    model = M.fit_rating_model(parts["train"])
    cold = parts["train"].agg(F.avg("rating_scaled")).first()[0]
    return M.predict_ratings(model, parts["test"], cold).select("user_id", "item_id", "rating_scaled", "p_rating")


@query("m1_fit_checks", """
    select split as dataset, count(*) as n, count(*) as in_range, case when split = 'train' then true end as beats_mean
    from fx_feature_split where split in ('train', 'test') group by split""")
def _(t: Tables) -> DataFrame:
    """What holds for any fit: a prediction in [0, 1] per row, and on its own rows a smaller error than their mean has."""
    parts = t.feature_splits()
    model = M.fit_rating_model(parts["train"])
    mean = parts["train"].agg(F.avg("rating_scaled")).first()[0]
    rows = parts["train"].withColumn("dataset", F.lit("train")).unionByName(parts["test"].withColumn("dataset", F.lit("test")))
    scored = M.predict_ratings(model, rows, mean)
    fitted, plain = ((F.col("rating_scaled") - value) ** 2 for value in (F.col("p_rating"), F.lit(mean)))
    better = F.when(F.col("dataset") == "train", F.avg(fitted) < F.avg(plain))
    return scored.groupBy("dataset").agg(
        F.count("*").alias("n"), F.count_if(F.col("p_rating").between(0, 1)).alias("in_range"), better.alias("beats_mean"))


@query("m2_two_heads")
def _(t: Tables) -> DataFrame:
    parts = t.feature_splits()
    heads, _ = two_heads(t)
    return S.hybrid_score(M.predict_two_heads(heads, parts["test"])).select(
        "user_id", "item_id", "rating_scaled", "p_inter", "p_rating", "hybrid_score"
    )


def two_heads(t: Tables) -> tuple[M.TwoHeads, ALSModel]:
    parts = t.feature_splits()
    factors = M.fit_rating_model(parts["train"], blocks=M.FEW_BLOCKS)
    sampled = negatives_per_positive(parts["train"], union_splits(*parts.values()), 2, items=t.item_attributes())
    return M.fit_two_heads(materialize(sampled.select(*M.HEAD_COLUMNS), "sampled"), factors), factors


@query("m2_cold_start", """
    with cold as (select f.*, row_number() over (partition by f.user_id order by f.ts, f.item_id) / count(*) over (partition by f.user_id) as share
        from fx_features f join fx_marked k on f.user_id = k.user_id and f.item_id = k.item_id where not k.kept),
      train as (select user_id, item_id from fx_split where split = 'train'),
      users as (select c.user_id, case when c.user_id in (select user_id from train) then 'fitted'
          when bool_or(share <= 0.5 and c.item_id in (select item_id from train)) then 'folded in' else 'none' end as user_state
        from cold c group by c.user_id),
      items as (select c.item_id, case when c.item_id in (select item_id from train) then 'fitted'
          when bool_or(share <= 0.5 and c.user_id in (select user_id from train)) then 'folded in' else 'none' end as item_state
        from cold c group by c.item_id)
    select user_id, item_id, user_state, item_state, true as in_range,
      case when user_state = 'none' or item_state = 'none' then true end as as_zero
    from cold join users using (user_id) join items using (item_id) where share > 0.5""")
def _(t: Tables) -> DataFrame:
    """Every cold pair is answered: with factors of the fit, with factors folded in from the user's older half, or as zero."""
    heads, factors = two_heads(t)
    halves = materialize(temporal_split(t.cold().drop("genres", "genres_multihot"), 0.5, 0.0), "cold-halves")
    known = M.complete_factors(factors, halves.filter("split = 'train'"))
    rows = M.predict_two_heads(M.with_factors(heads, *known), halves.filter("split <> 'train'"))
    for key, fitted, complete in (("user", factors.userFactors, known[0]), ("item", factors.itemFactors, known[1])):
        ids = complete.select(F.col("id").alias(f"{key}_idx"), F.lit("folded in").alias(f"{key}_state")).join(
            fitted.select(F.col("id").cast("bigint").alias(f"{key}_idx"), F.lit("fitted").alias("_fitted")), f"{key}_idx", "left")
        state = F.coalesce("_fitted", f"{key}_state", F.lit("none")).alias(f"{key}_state")
        rows = rows.join(ids, f"{key}_idx", "left").withColumn(f"{key}_state", state).drop("_fitted")
    zero = 1 / (1 + F.exp(F.lit(-float(heads.interaction.intercept))))
    alone = (F.col("user_state") == "none") | (F.col("item_state") == "none")
    return rows.select(
        "user_id", "item_id", "user_state", "item_state",
        (F.col("p_inter").between(0, 1) & F.col("p_rating").between(0, 1)).alias("in_range"),
        F.when(alone, F.abs(F.col("p_inter") - zero) < 1e-9).alias("as_zero"),
    )


@query("m3_gmf_score", f"""
    select a.vec_id as item_id, round({_SIGMOID.format(
        "list_sum(list_transform(range(64), lambda j: a.embedding[j + 1]::double * b.embedding[j + 1]::double "
        "* (((j * 13 + 9) % 11 - 5) / 20.0::double))) + 0.05::double")}, 6) as score
    from embeddings a join (select label, arg_min(embedding, vec_id) as embedding from embeddings group by label) b
      on a.label = b.label""")
def _(t: Tables) -> DataFrame:
    rows = t.read("embeddings")
    first = rows.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("user_vector"))
    pairs = rows.select("label", F.col("vec_id").alias("item_id"), F.col("embedding").alias("item_vector")).join(first, "label")
    return S.gmf_score(pairs, rule_weights(DIM, 9), 0.05).select("item_id", F.round("score", 6).alias("score"))


@query("m4_modality_attention", f"""
    select vec_id as item_id, round(e[1] / list_sum(e), 6) as category, round(e[2] / list_sum(e), 6) as text,
      round(e[3] / list_sum(e), 6) as image, round(list_sum(list_transform(embedding, lambda x: x::double)) * e[2] / list_sum(e), 6) as text_total
    from (select vec_id, embedding, [exp({dot_sql('embedding', DIM, 3)} + 0.1::double), exp({dot_sql('embedding', DIM, 4)}),
      exp({dot_sql('embedding', DIM, 5)} - 0.1::double)] as e from embeddings)""")
def _(t: Tables) -> DataFrame:
    vector = F.col("embedding")
    rows = t.read("embeddings").select(
        F.col("vec_id").alias("item_id"), vector.alias("cat_vec"), vector.alias("text_vec"), vector.alias("img_vec")
    )
    scored = S.modality_attention(rows, {
        "cat_vec": (rule_weights(DIM, 3), 0.1), "text_vec": (rule_weights(DIM, 4), 0.0), "img_vec": (rule_weights(DIM, 5), -0.1),
    })
    shares = [F.round(F.get("weights", F.lit(place)), 6).alias(name) for place, name in enumerate(("category", "text", "image"))]
    return scored.select("item_id", *shares, F.round(V.total(F.col("text_vec_weighted")), 6).alias("text_total"))


@query("m5_hybrid_score", "select model, user_id, item_id, p_inter * p_rating as hybrid_score from fx_scored")
def _(t: Tables) -> DataFrame:
    return S.hybrid_score(t.predictions).select("model", "user_id", "item_id", "hybrid_score")


@query("m6_user_tower", _long_sql("user_id", "user_vector", _USER_SQL))
def _(t: Tables) -> DataFrame:
    return _long(user_vectors(t), "user_id", "user_vector")


@query("m7_item_tower", _long_sql("item_id", "list_concat(item_vector, weights)", _ITEM_SQL))
def _(t: Tables) -> DataFrame:
    both = item_vectors(t).withColumn("both", F.concat("item_vector", "weights"))
    return _long(both, "item_id", "both")


_PAIRS_SQL = f"""
    select user_id, item_id, {_head_sql(9, 0.05)} as p_rating, {_head_sql(10, -0.05)} as p_inter, weights from (
      select p.user_id, p.item_id, coalesce(u.user_vector, z.zero) as user_vector, coalesce(i.item_vector, z.zero) as item_vector, i.weights
      from fx_interactions p left join ({_USER_SQL}) u on p.user_id = u.user_id left join ({_ITEM_SQL}) i on p.item_id = i.item_id,
        (select list_transform(range({OUT}), lambda n: 0.0::double) as zero) z)"""


@query("m8_score_pairs", f"""
    select user_id, item_id, round(p_rating, 6) as p_rating, round(p_rating * 4.0 + 1.0, 6) as stars, round(p_inter, 6) as p_inter,
      round(p_rating * p_inter, 6) as hybrid_score, round(weights[2], 6) as text_share from ({_PAIRS_SQL})""")
def _(t: Tables) -> DataFrame:
    names = ("p_rating", "stars", "p_inter", "hybrid_score")
    text = F.get_json_object("attention_weights", "$.text").cast("double")
    pairs = t.interactions.select("user_id", "item_id")
    return S.score_pairs(pairs, user_vectors(t), item_vectors(t), RATING_HEAD, INTERACTION_HEAD).select(
        "user_id", "item_id", *[F.round(name, 6).alias(name) for name in names], F.round(text, 6).alias("text_share")
    )


_EXACT_SQL = """
    select user_id, item_id, rank, score from (
      select *, row_number() over (partition by user_id order by score desc, item_id) as rank from (
        select u.vec_id as user_id, i.vec_id as item_id,
          list_dot_product(u.embedding::double[], i.embedding::double[]) as score
        from embeddings u, embeddings i
        where not exists (select 1 from fx_interactions s where s.user_id = u.vec_id and s.item_id = i.vec_id)))
    where rank <= 10"""


def _exact(t: Tables) -> DataFrame:
    items = t.vectors.select("item_id", F.col("text_emb").alias("vector"))
    seen = t.stored() if "stored" in t.derived else t.interactions
    return S.recommend_top_k(items.withColumnRenamed("item_id", "user_id"), items, seen, 10)


def _by_index(t: Tables) -> DataFrame:
    items = t.vectors.select("item_id", F.col("text_emb").alias("vector"))
    index = I.fit_item_index(items)
    return I.search_top_k(items.withColumnRenamed("item_id", "user_id"), index, t.stored(), 10, probes=ceil(len(index.centres) * PROBED))


@query("m9_recommend_top_k", f"select user_id, item_id, rank, round(score, 6) as score from ({_EXACT_SQL})")
def _(t: Tables) -> DataFrame:
    return _exact(t).select("user_id", "item_id", "rank", F.round("score", 6).alias("score"))


@query("m9_index_search")
def _(t: Tables) -> DataFrame:
    return _by_index(t).select("user_id", "item_id", "rank", F.round("score", 6).alias("score"))


@query("m9_index_recall", """
    select count(*) as users, sum(least(10, unseen)) as wanted, true as enough, sum(least(10, unseen)) as exact_scores from (
      select u.vec_id, (select count(*) from embeddings) - count(s.item_id) as unseen
      from embeddings u left join fx_interactions s on s.user_id = u.vec_id and s.item_id in (select vec_id from embeddings) group by u.vec_id)""")
def _(t: Tables) -> DataFrame:
    """The index against the exact search: recall at 10 of at least 0.9, and the true score for every pair it returns."""
    found = materialize(_by_index(t), "index-search")
    recall = I.recall_at_k(found, _exact(t)).select("wanted", (F.col("recall") >= 0.9).alias("enough"))
    vectors = t.vectors.select("item_id", V.doubles(F.col("text_emb")).alias("_v"))
    scored = found.join(vectors, "item_id").join(vectors.select(F.col("item_id").alias("user_id"), F.col("_v").alias("_u")), "user_id")
    right = scored.agg(
        F.count_distinct("user_id").alias("users"), F.count_if(F.abs(V.dot(F.col("_u"), F.col("_v")) - F.col("score")) < 1e-9).alias("exact_scores"))
    return recall.join(right)


@query("m9_recommendations", f"""
    select r.user_id, r.item_id, r.rank, round({_head_sql(9, 0.05)} * 4.0 + 1.0, 6) as stars, round(weights[2], 6) as text_share,
      round({_head_sql(9, 0.05)} * {_head_sql(10, -0.05)}, 6) as hybrid_score
    from ({_EXACT_SQL}) r join ({_USER_SQL}) u on r.user_id = u.user_id join ({_ITEM_SQL}) i on r.item_id = i.item_id""")
def _(t: Tables) -> DataFrame:
    """Recommendations as a table: the ten best items of every user with stars, attention text and hybrid score."""
    table = S.recommendations(_exact(t), user_vectors(t), item_vectors(t), RATING_HEAD, INTERACTION_HEAD)
    text = F.get_json_object("attention_weights", "$.text").cast("double")
    return table.select(
        "user_id", "item_id", "rank", F.round("stars", 6).alias("stars"), F.round(text, 6).alias("text_share"),
        F.round("hybrid_score", 6).alias("hybrid_score"))


@query("m10_tune", """
    select t.trial, t.rank, t.reg, r.rung, r.iterations, true as finite, true as in_order
    from (select row_number() over (order by rank, reg) as trial, rank, reg from (select unnest([4, 6, 8, 10]) as rank), (select cast(unnest([0.05, 0.1, 0.2]) as double) as reg)) t,
      (select 0 as rung, 2 as iterations) r""")
def _(t: Tables) -> DataFrame:
    """First rung of a search over twelve trials, three at once; ``in_order``: the four best of it, and no others, went on."""
    parts = t.feature_splits()
    trials = materialize(M.tune(parts["train"], parts["val"], [4, 6, 8, 10], [0.05, 0.1, 0.2], iterations=8), "trials")
    place = F.row_number().over(Window.partitionBy("rung").orderBy("objective", "trial"))
    next_rung = trials.select((F.col("rung") - 1).alias("rung"), "trial", F.lit(True).alias("_went_on"))
    placed = trials.withColumn("_place", place).join(next_rung, ["rung", "trial"], "left")
    in_order = (F.col("_place") <= 4) == F.coalesce("_went_on", F.lit(False))
    return placed.filter("rung = 0").select(
        "trial", "rank", "reg", F.col("rung").cast("int").alias("rung"), F.col("iterations").cast("int").alias("iterations"),
        (~F.isnan("objective") & (F.col("objective") < 4)).alias("finite"), in_order.alias("in_order"))


@query("m10_search_rungs", """
    select rung, trials, iterations, trials as distinct_trials, true as best_first
    from (select unnest([0, 1, 2]) as rung, unnest([12, 4, 2]) as trials, unnest([2, 4, 8]) as iterations)""")
def _(t: Tables) -> DataFrame:
    """Trials and iterations per rung of the search; ``best_first``: nobody who left a rung was better than who stayed."""
    parts = t.feature_splits()
    trials = M.tune(parts["train"], parts["val"], [4, 6, 8, 10], [0.05, 0.1, 0.2], iterations=8)
    stayed, left = F.max(F.when(F.col("survived"), F.col("objective"))), F.min(F.when(~F.col("survived"), F.col("objective")))
    return trials.groupBy(F.col("rung").cast("int").alias("rung")).agg(
        F.count("*").alias("trials"), F.max("iterations").cast("int").alias("iterations"), F.count_distinct("trial").alias("distinct_trials"),
        (stayed <= left).alias("best_first"))


@query("m11_explain", f"""
    select user_id, item_id, round(p_rating * 4.0 + 1.0, 6) as stars, round(weights[1] * 100, 6) as category_pct,
      round(weights[2] * 100, 6) as text_pct, round(weights[3] * 100, 6) as image_pct from ({_PAIRS_SQL})
    where user_id = 7 and item_id = (select min(item_id) from fx_interactions where user_id = 7)""")
def _(t: Tables) -> DataFrame:
    item = t.interactions.filter("user_id = 7").agg(F.min("item_id")).first()[0]
    pair = t.spark.createDataFrame([(7, item)], "user_id long, item_id long")
    scored = S.score_pairs(pair, user_vectors(t, pair), item_vectors(t, pair), RATING_HEAD, INTERACTION_HEAD)
    names = ("stars", "category_pct", "text_pct", "image_pct")
    return S.explain(scored, 7, item).select(
        "user_id", "item_id", *[F.round(name, 6).alias(name) for name in names]
    )


@query("q1_regression_metrics", "select model, dataset, mse, rmse, rmse_stars, n_samples from fx_pointwise", digits=6)
def _(t: Tables) -> DataFrame:
    return Q.regression_metrics(t.evaluation(), ["model", "dataset"])


@query("q2_bce", "select model, dataset, bce from fx_pointwise", digits=6)
def _(t: Tables) -> DataFrame:
    return Q.bce(t.evaluation(), ["model", "dataset"])


@query("q3_masked_mse", "select model, dataset, masked_mse from fx_pointwise", digits=6)
def _(t: Tables) -> DataFrame:
    return Q.masked_mse(t.evaluation(), ["model", "dataset"])


@query("q4_confusion", "select model, dataset, tp, fp, fn, tn from fx_pointwise")
def _(t: Tables) -> DataFrame:
    return Q.confusion(t.evaluation(), 3.5, ["model", "dataset"])


@query("q5_classification_metrics", "select model, dataset, tp, fp, fn, tn, accuracy, precision, recall, f1 from fx_rates", digits=6)
def _(t: Tables) -> DataFrame:
    return Q.classification_metrics(t.evaluation(), 3.5, by=["model", "dataset"])


@query("q6_classification_at_probability", """
    select *, round((tp + tn) / (tp + fp + fn + tn + 1e-8), 6) as accuracy,
      round(tp / (tp + fp + 1e-8), 6) as precision, round(tp / (tp + fn + 1e-8), 6) as recall,
      round(2 * (tp / (tp + fp + 1e-8)) * (tp / (tp + fn + 1e-8)) / (tp / (tp + fp + 1e-8) + tp / (tp + fn + 1e-8) + 1e-8), 6) as f1
    from (select model, count(*) filter (where p_inter >= 0.5 and y > 0) as tp, count(*) filter (where p_inter >= 0.5 and y <= 0) as fp,
      count(*) filter (where p_inter < 0.5 and y > 0) as fn, count(*) filter (where p_inter < 0.5 and y <= 0) as tn
      from fx_scored group by model)""", digits=6)
def _(t: Tables) -> DataFrame:
    return Q.classification_metrics(t.predictions, prob=0.5, by=["model"])


@query("q7_classification_report", """
    with c as (select source, count(*) filter (where toxic = 1 and quality = 1) as tp, count(*) filter (where toxic = 1 and quality = 0) as fp,
        count(*) filter (where toxic = 0 and quality = 1) as fn, count(*) filter (where toxic = 0 and quality = 0) as tn
      from labels l join documents d on l.doc_id = d.doc_id group by source),
    k as (select source, 'relevant' as class, tp as hit, fp as wrong, fn as missed from c
      union all select source, 'irrelevant', tn, fn, fp from c),
    s as (select source, class, coalesce(hit / nullif(hit + wrong, 0), 0) as precision, coalesce(hit / nullif(hit + missed, 0), 0) as recall,
      coalesce(2 * hit / nullif(2 * hit + wrong + missed, 0), 0) as f1, hit + missed as support from k)
    select source, class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from s
    union all select source, 'macro', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), cast(sum(support) as bigint) from s group by source
    union all select source, 'weighted', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
      round(sum(f1 * support) / sum(support), 6), cast(sum(support) as bigint) from s group by source""", digits=6)
def _(t: Tables) -> DataFrame:
    # The quality label is the truth and the toxicity flag plays the prediction; 1 is five stars, 0 is one star.
    rows = t.read("labels").join(t.read("documents").select("doc_id", "source"), "doc_id").select(
        "source", F.col("quality").cast("double").alias("y"), F.col("toxic").cast("double").alias("p_rating")
    )
    return Q.classification_report(rows, 4.0, ["source"])


@query("q8_confusion_pct", """
    select model, dataset, round(tp * 100.0::double / n_samples, 6) as tp_pct, round(fp * 100.0::double / n_samples, 6) as fp_pct,
      round(fn * 100.0::double / n_samples, 6) as fn_pct, round(tn * 100.0::double / n_samples, 6) as tn_pct from fx_pointwise""", digits=6)
def _(t: Tables) -> DataFrame:
    return Q.confusion_pct(Q.confusion(t.evaluation(), 3.5, ["model", "dataset"])).drop("tp", "fp", "fn", "tn")


@query("w3_top_k", """
    select model, user_id, item_id, rank from (select *, row_number() over (partition by model, user_id order by p_rating desc, item_id) as rank
      from fx_scored) where rank <= 10""")
def _(t: Tables) -> DataFrame:
    best = K.top_k(t.predictions, 10, [F.desc("p_rating"), F.asc("item_id")], ["model", "user_id"])
    return best.select("model", "user_id", "item_id", "rank")


def ranks(t: Tables) -> DataFrame:
    """Rank of each target among its decoys per model, by a seeded score."""
    chosen = materialize(decoy_rows(t), "decoys")
    targets = chosen.select("user_id", "target").distinct().withColumn("item_id", F.col("target"))
    rows = chosen.withColumn("is_target", F.lit(False)).unionByName(targets.withColumn("is_target", F.lit(True)))
    rows = rows.withColumn("model", F.explode(F.array(*[F.lit(name) for name in MODELS])))
    ids = [F.col("user_id"), F.col("item_id")]
    inter = F.when(F.col("model") == "twoheads", hash_unit(F.col("model"), F.lit("i"), *ids)).otherwise(F.lit(1.0))
    scored = rows.withColumn("score", inter * hash_unit(F.col("model"), F.lit("r"), *ids))
    return K.target_rank(materialize(scored.select("model", "user_id", "target", "is_target", "score"), "scored-candidates"), ["model", "user_id", "target"])


@query("w4_target_rank", "select model, user_id, target, rank from fx_ranks")
def _(t: Tables) -> DataFrame:
    return ranks(t)


@query("q9_hit_rate", "select model, hit_rate_at_k, total_evaluations from fx_ranking", digits=6)
def _(t: Tables) -> DataFrame:
    return K.hit_rate(ranks(t), 10, ["model"])


@query("q10_ndcg_single", "select model, ndcg_at_k, total_evaluations from fx_ranking", digits=6)
def _(t: Tables) -> DataFrame:
    return K.ndcg_single(ranks(t), 10, ["model"])


@query("q11_ndcg_graded", """
    select model, dataset, round(avg(dcg / idcg), 6) as ndcg_at_k, count(*) as users from (
      select model, dataset, user_id,
        sum((power(2, y * 4.0 + 1.0) - 1) / log2(pr + 1)) filter (where pr <= 10) as dcg,
        sum((power(2, y * 4.0 + 1.0) - 1) / log2(ir + 1)) filter (where ir <= 10) as idcg
      from (select *, row_number() over (partition by model, dataset, user_id order by p_rating desc, item_id) as pr,
          row_number() over (partition by model, dataset, user_id order by y desc, item_id) as ir from fx_evaluation)
      group by model, dataset, user_id)
    group by model, dataset""", digits=6)
def _(t: Tables) -> DataFrame:
    return K.ndcg_graded(materialize(t.evaluation(), "evaluation"), 10, ["model", "dataset"])


@query("q12_precision_recall_at_k", "select model, dataset, precision_at_k, recall_at_k, users from fx_at_k", digits=6)
def _(t: Tables) -> DataFrame:
    return K.precision_recall_at_k(materialize(t.evaluation(), "evaluation"), 10, 3.5, ["model", "dataset"])


def bundle(t: Tables) -> DataFrame:
    predictions = materialize(t.evaluation(), "evaluation")
    of_test = ranks(t).withColumn("dataset", F.lit("test"))
    return materialize(rounded(evaluate(predictions, of_test, attention=item_vectors(t))), "bundle")


ATTENTION_SQL = f"""
    select model, dataset, round(avg(weights[1]) * 100, 6) as category_pct, round(avg(weights[2]) * 100, 6) as text_pct,
      round(avg(weights[3]) * 100, 6) as image_pct from fx_evaluation e join ({_ITEM_SQL}) i on e.item_id = i.item_id group by model, dataset"""


@query("q13_evaluate", f"""
    select a.category_pct, a.text_pct, a.image_pct, p.model, p.dataset, p.mse, p.rmse, p.rmse_stars, p.n_samples, p.bce, p.masked_mse, p.tp, p.fp, p.fn, p.tn, p.accuracy,
      p.precision, p.recall, p.f1, k.precision_at_k, k.recall_at_k,
      coalesce(r.hit_rate_at_k, -1) as hit_rate_at_k, coalesce(r.ndcg_at_k, -1) as ndcg_at_k, coalesce(r.total_evaluations, 0) as total_evaluations
    from fx_rates p left join fx_at_k k on p.model = k.model and p.dataset = k.dataset
    left join fx_ranking r on p.model = r.model and p.dataset = r.dataset
    left join ({ATTENTION_SQL}) a on p.model = a.model and p.dataset = a.dataset""")
def _(t: Tables) -> DataFrame:
    return bundle(t).fillna({"hit_rate_at_k": -1.0, "ndcg_at_k": -1.0, "total_evaluations": 0})


@query("q13_from_splits", """
    with halves as (select k.user_id, row_number() over (partition by k.user_id order by k.ts, k.item_id) / count(*) over (partition by k.user_id) as share
        from fx_marked k where not k.kept),
      n as (select 'test' as dataset, count(*) as n_samples, (select count(distinct (user_id, target)) from fx_decoys) as total_evaluations
          from fx_split where split = 'test'
        union all select 'coldstart', count(*), 0 from halves where share > 0.5)
    select model, dataset, n_samples, total_evaluations, true as rates_in_range, true as scored
    from n, (select unnest(['regression', 'twoheads']) as model)""")
def _(t: Tables) -> DataFrame:
    """From splits to a winner with fitted models: what holds for any fit. ``scored``: exactly one winner, with the best score."""
    parts = t.feature_splits()
    found = materialize(fitted_bundle(parts, t.cold(), t.vectors.select("item_id")), "fitted-bundle")
    scores = R.composite_score(summary_of(found))
    winner = R.select_winner(scores)
    fine = scores.agg(F.max("score").alias("_best")).join(winner).select(
        (F.col("_best").eqNullSafe(F.col("winner_score")) & F.col("winner").isin(*MODELS)).alias("scored"))
    rates = [F.coalesce(name, F.lit(0.0)).between(0, 1) for name in (
        "accuracy", "precision", "recall", "f1", "precision_at_k", "recall_at_k", "hit_rate_at_k", "ndcg_at_k", "mse")]
    return found.join(fine).select(
        "model", "dataset", "n_samples", F.coalesce("total_evaluations", F.lit(0)).alias("total_evaluations"),
        reduce(lambda a, b: a & b, rates).alias("rates_in_range"), "scored")


def summary(t: Tables) -> DataFrame:
    return summary_of(bundle(t))


@query("r1_composite_score", "select model, score from fx_scores", digits=6)
def _(t: Tables) -> DataFrame:
    return R.composite_score(summary(t)).select("model", "score")


@query("r2_select_winner", """
    select model as winner, score as winner_score from fx_scores order by score desc, model = 'twoheads' desc limit 1""", digits=6)
def _(t: Tables) -> DataFrame:
    return R.select_winner(R.composite_score(summary(t)))


@query("r3_quality_gate", """
    select model, rmse_stars <= 2.0 as rmse_ok, ndcg_at_k >= 0.3 as ndcg_ok, rmse_stars <= 2.0 and ndcg_at_k >= 0.3 as passed from fx_summary""")
def _(t: Tables) -> DataFrame:
    return R.quality_gate(summary(t), min_ndcg=R.MIN_NDCG).select("model", "rmse_ok", "ndcg_ok", "passed")


@query("r4_comparison_table", """
    select metric, max(value) filter (where model = 'regression') as regression, max(value) filter (where model = 'twoheads') as twoheads
    from (unpivot (select model, rmse_stars, hit_rate_at_k, ndcg_at_k, precision_at_k, recall_at_k from fx_summary)
      on rmse_stars, hit_rate_at_k, ndcg_at_k, precision_at_k, recall_at_k into name metric value value) group by metric""")
def _(t: Tables) -> DataFrame:
    metrics = ["rmse_stars", "hit_rate_at_k", "ndcg_at_k", "precision_at_k", "recall_at_k"]
    return R.comparison_table(summary(t), metrics, MODELS)


@query("r5_coldstart_gap", """
    select t.model, t.rmse_stars as test_rmse, c.rmse_stars as coldstart_rmse, round(c.rmse_stars - t.rmse_stars, 6) as gap
    from fx_pointwise t join fx_pointwise c on t.model = c.model where t.dataset = 'test' and c.dataset = 'coldstart'""", digits=6)
def _(t: Tables) -> DataFrame:
    return R.coldstart_gap(rounded(Q.regression_metrics(t.evaluation(), ["model", "dataset"])))


@query("r6_score_breakdown", """
    select model, criterion, weight, value, round(weight * value, 6) as contribution from (
      select model, 'ndcg' as criterion, 0.40::double as weight, ndcg_at_k as value from fx_summary
      union all select model, 'hr', 0.25::double, hit_rate_at_k from fx_summary
      union all select model, 'rmse_inv', 0.20::double, greatest(0.0::double, 1.0 - rmse_stars / 4.0) from fx_summary
      union all select model, 'precision', 0.15::double, precision_at_k from fx_summary)""")
def _(t: Tables) -> DataFrame:
    return R.score_breakdown(summary(t)).withColumn("contribution", F.round("contribution", 6))


@query("t2_leaderboard", """
    select trial, objective, lr, emb_dim from (select c_custkey as trial, c_acctbal as objective, c_acctbal / 1000000 as lr,
      c_nationkey as emb_dim from customer) order by objective, trial limit 1""")
def _(t: Tables) -> DataFrame:
    return R.leaderboard(t.trials, "objective", ["lr", "emb"], ["trial"])
