"""The inputs of ``tables.Tables`` as SQL views over the given tables (DuckDB dialect)."""

from __future__ import annotations


def draw(*parts: str) -> str:
    """SQL of ``functions.features.hash_int``."""
    joined = " || '|' || ".join(f"cast({part} as varchar)" for part in parts)
    return f"cast(('0x' || substr(md5({joined}), 1, 15)) as bigint)"


def unit(*parts: str) -> str:
    return f"({draw(*parts)} / 1152921504606846976.0::double)"


def _permuted(place: str) -> str:
    """SQL of ``functions.features.permute`` over the columns a (rows), b (cols) and k0 to k7."""
    halves = [f"({place} // b)", f"({place} % b)"]
    for step, size in enumerate("abab"):
        moved, other = step % 2, 1 - step % 2
        hashed = f"(({halves[other]} + k{2 * step}) % 2147483647 * (k{2 * step + 1} % 2147483646 + 1) % 2147483647)"
        halves[moved] = f"(({halves[moved]} + {hashed}) % {size})"
    return f"({halves[0]} * b + {halves[1]})"


def drawn(requests: str, key: list[str], pool: str, history: str, seed: int = 42) -> str:
    """SQL of ``operators.sampling.draw_unseen``: the requests' ``key`` with ``item_id`` and ``draw``."""
    keys = ", ".join(key)
    digests = [f"md5('{at}|{seed}|' || {" || '|' || ".join(f'cast(q.{name} as varchar)' for name in key)})" for at in (0, 1)]
    numbers = ", ".join(
        f"cast(('0x' || substr({digests[at // 4]}, {8 * (at % 4) + 1}, 8)) as bigint) % 2147483647 as k{at}" for at in range(8))
    held = f"{keys}, user_id, m, a, b, {', '.join(f'k{at}' for at in range(8))}, draw"
    held = held if "user_id" not in key else held.replace(" user_id, m,", " m,")
    return f"""(with recursive
      pool_ as (select item_id, row_number() over (order by item_id) - 1 as idx from (select distinct item_id from ({pool}))),
      asked_ as (select * from ({requests})),
      seen_ as (select distinct h.user_id, l.idx from ({history}) h join pool_ l on h.item_id = l.item_id
        where h.user_id in (select user_id from asked_)),
      free_ as (select u.user_id, l.item_id, row_number() over (partition by u.user_id order by l.idx) - 1 as place
        from (select distinct user_id from asked_) u cross join pool_ l left join seen_ s on s.user_id = u.user_id and s.idx = l.idx
        where s.user_id is null),
      sizes_ as (select user_id, count(*) as m, cast(ceil(sqrt(count(*))) as bigint) as a from free_ group by user_id),
      keyed_ as (select q.*, z.m, z.a, cast(ceil(z.m / z.a) as bigint) as b, {numbers}, unnest(range(least(q.need, z.m))) as draw
        from asked_ q join sizes_ z on q.user_id = z.user_id),
      walk_ as (select {held}, {_permuted("draw")} as place from keyed_
        union all select {held}, {_permuted("place")} from walk_ where place >= m)
      select {", ".join("w." + name for name in key)}, f.item_id, w.draw from walk_ w join free_ f on f.user_id = w.user_id and f.place = w.place
      where w.place < w.m)"""


def decoys(targets: str, interactions: str, wanted: int = 99, bad_stars: str = "2.5", least: int = 10) -> str:
    """SQL of ``operators.sampling.decoys`` over all embedded items."""
    key = ["user_id", "target"]
    bad = f"select item_id from ({interactions}) where rating_scaled <= ({bad_stars} - 1) / 4"
    others = f"select item_id from ({interactions}) where item_id not in ({bad})"
    first = drawn(f"select user_id, target, {wanted} as need from ({targets})", key, bad, interactions)
    short = f"""select t.user_id, t.target, {wanted} - count(d.item_id) as need from ({targets}) t left join ({first}) d
        on t.user_id = d.user_id and t.target = d.target group by t.user_id, t.target having count(d.item_id) < {wanted}"""
    more = drawn(short, key, others, interactions, 43)
    return f"""select user_id, target, item_id from (
        select *, count(*) over (partition by user_id, target) as usable from (
          select user_id, target, item_id from {first} union all select user_id, target, item_id from {more})
        where item_id in (select vec_id from embeddings))
      where usable >= {least}"""


VIEWS = {
    "fx_ratings": """
        select o_custkey as user_id, l_partkey as item_id,
          cast(((cast(l_quantity as int) + l_linenumber) % 10 + 1) * 0.5 as double) as rating,
          cast(epoch(o_orderdate) as bigint) as ts, l_orderkey, l_linenumber, l_extendedprice
        from lineitem join orders on l_orderkey = o_orderkey""",
    "fx_interactions": """
        select user_id, item_id, rating, ts from (
          select *, row_number() over (partition by user_id, item_id
            order by ts desc, l_orderkey desc, l_linenumber desc, l_extendedprice desc) as rn
          from fx_ratings) where rn = 1""",
    "fx_links": """
        select l_partkey as item_id, case when p_brand <> 'Brand#25' then l_partkey + 100000 end as ext_id
        from lineitem join part on l_partkey = p_partkey""",
    "fx_catalog": """
        select p_partkey as item_id, p_name as title, string_split(p_name, ' ') as name_parts,
          p_name || ' ' || p_type as genre_words, p_brand as director,
          case when p_size <= 2 then null when p_size <= 4 then '' when p_size <= 6 then 'None'
            else '/' || cast(p_partkey as varchar) || '.jpg' end as asset_path,
          p_size as size
        from part where p_type <> 'PROMO'""",
    "fx_assets": """
        select item_id from fx_catalog
        where asset_path is not null and asset_path not in ('', 'None') and size <= 40""",
    "fx_silver": """
        select user_id, item_id, rating, ts from (
          select *, row_number() over (partition by user_id, item_id
            order by ts desc, rating desc, l_orderkey desc, l_linenumber desc, l_extendedprice desc) as rn
          from fx_ratings
          where item_id in (select item_id from fx_links where ext_id is not null)
            and item_id in (select item_id from fx_catalog) and item_id in (select item_id from fx_assets))
        where rn = 1""",
    "fx_genres": """
        select i.item_id, coalesce(replace(c.genre_words, ' ', '|'), 'Desconocido') as genres
        from (select distinct item_id from fx_interactions) i left join fx_catalog c on i.item_id = c.item_id""",
    "fx_vocabulary": """
        select word, row_number() over (order by word) - 1 as idx
        from (select distinct unnest(string_split(genres, '|')) as word from fx_genres)""",
    "fx_item_dim": """
        select g.item_id, g.genres, dense_rank() over (order by g.item_id) - 1 as item_idx,
          (select string_agg(case when list_contains(string_split(g.genres, '|'), v.word) then '1' else '0' end,
            ',' order by v.word) from fx_vocabulary v) as multihot
        from fx_genres g""",
    "fx_user_dim": """
        select user_id, row_number() over (order by user_id) - 1 as user_idx
        from (select distinct user_id from fx_interactions)""",
    "fx_features": """
        select i.user_id, i.item_id, i.rating, i.ts, d.genres,
          (i.rating - (select min(rating) from fx_interactions))
            / (select max(rating) - min(rating) from fx_interactions) as rating_scaled,
          u.user_idx, d.item_idx, d.multihot
        from fx_interactions i join fx_user_dim u on i.user_id = u.user_id
        join fx_item_dim d on i.item_id = d.item_id""",
    "fx_ok_users": "select user_id from fx_interactions group by user_id having count(*) >= 20",
    "fx_ok_items": """
        select item_id from fx_interactions where user_id in (select user_id from fx_ok_users)
        group by item_id having count(*) >= 22""",
    "fx_marked": """
        select *, user_id in (select user_id from fx_ok_users) and item_id in (select item_id from fx_ok_items) as kept
        from fx_interactions""",
    "fx_split": """
        select user_id, item_id, rating, ts,
          case when share <= 0.8::double then 'train' when share <= 0.8::double + 0.1::double then 'val' else 'test' end as split
        from (select *, row_number() over (partition by user_id order by ts, item_id)
            / count(*) over (partition by user_id) as share
          from fx_marked where kept)""",
    "fx_feature_split": """
        select f.*, s.split from fx_features f join fx_split s on f.user_id = s.user_id and f.item_id = s.item_id""",
    "fx_models": "select unnest(['regression', 'twoheads']) as model",
    "fx_scored": f"""
        select m.model, i.user_id, i.item_id, i.rating, (i.rating - 0.5) / 4.5 as y,
          0.6::double * (i.rating - 0.5) / 4.5 + 0.4::double * {unit("m.model", "'r'", "i.user_id", "i.item_id")} as p_rating,
          {unit("m.model", "'i'", "i.user_id", "i.item_id")} as p_inter
        from fx_interactions i, fx_models m""",
    "fx_evaluation": """
        select s.*, case when k.kept then 'test' else 'coldstart' end as dataset
        from fx_scored s join fx_marked k on s.user_id = k.user_id and s.item_id = k.item_id
        left join fx_split p on s.user_id = p.user_id and s.item_id = p.item_id
        where not k.kept or p.split = 'test'""",
    "fx_logs": """
        select user_id % 10 as job, event_id as seq, case
          when event_type = 'error' then 'test_bce=' || cast(value as varchar) || ';'
          when event_type = 'click' then 'train_mse=' || cast(value as varchar) || ';'
          when event_type = 'view' then 'val_mse=' || cast(value as varchar) || ';'
          when event_type = 'signup' then 'val_rmse_stars=' || cast(value as varchar) || ';'
          else 'Epoch ' || cast(event_id as varchar) || ' | train_total_loss=' || cast(value as varchar)
            || '; train_bce=0.5; lr=1.00e-03;' end as message
        from events""",
    "fx_regression_logs": """
        select user_id % 10 as job, event_id as seq, 'Epoch ' || cast(event_id as varchar) || ' | ' || case
          when event_type = 'error' then 'test_mse=' || cast(value as varchar) || ';'
          when event_type = 'signup' then 'train_mse=' || cast(value as varchar) || '; lr=1.00e-03;'
          else 'train_mse=' || cast(value as varchar) || '; val_mse=1' || cast(value as varchar)
            || '; val_rmse_stars=2' || cast(value as varchar) || '; lr=5.00e-04;' end as message
        from events""",
    "fx_history": """
        select user_id as job, event_id as epoch, value as val_mse, cast(floor(value / 50) as double) as lr from events""",
    "fx_attention": """
        select event_id as rec_id, case
          when event_type = 'error' then 'not json'
          when event_type = 'signup' then '{"category":0,"text":0.'
            || lpad(cast(cast(round(value * 100) as int) % 100 as varchar), 2, '0') || ',"image":0.5}'
          else '{"category":0.05,"text":0.'
            || lpad(cast(cast(round(value * 100) as int) % 100 as varchar), 2, '0') || ',"image":0.25}' end
          as attention_weights
        from events""",
    "fx_attention_pct": """
        select rec_id, nullif(cast(w ->> '$.category' as double), 0) * 100 as category_pct,
          nullif(cast(w ->> '$.text' as double), 0) * 100 as text_pct,
          nullif(cast(w ->> '$.image' as double), 0) * 100 as image_pct
        from (select rec_id, case when json_valid(attention_weights) then cast(attention_weights as json) end as w
          from fx_attention)""",
    "fx_images": "select vec_id as item_id, embedding as img_emb from embeddings where label < 5",
    "fx_targets": """
        select user_id, item_id as target from fx_feature_split
        where split = 'test' and rating_scaled >= (3.5 - 1) / 4 and item_id in (select vec_id from embeddings)""",
    "fx_decoys": decoys("select * from fx_targets", "select user_id, item_id, rating_scaled from fx_feature_split"),
    "fx_ranked": f"""
        select m.model, c.user_id, c.target, c.is_target,
          case when m.model = 'twoheads' then {unit("m.model", "'i'", "c.user_id", "c.item_id")} else 1.0::double end
            * {unit("m.model", "'r'", "c.user_id", "c.item_id")} as score
        from (select user_id, target, item_id, false as is_target from fx_decoys
          union all select distinct user_id, target, target, true from fx_decoys) c, fx_models m""",
    "fx_ranks": """
        select c.model, c.user_id, c.target, cast(count(*) filter (where not c.is_target and c.score > t.score) as bigint) as rank
        from fx_ranked c join fx_ranked t
          on c.model = t.model and c.user_id = t.user_id and c.target = t.target and t.is_target
        group by c.model, c.user_id, c.target""",
    "fx_pointwise": """
        select model, dataset, round(avg(power(p_rating - y, 2)), 6) as mse,
          round(sqrt(avg(power(p_rating - y, 2))), 6) as rmse,
          round(sqrt(avg(power(p_rating - y, 2))) * 4.0, 6) as rmse_stars, count(*) as n_samples,
          round(avg(-(case when y > 0 then ln(p_inter + 1e-8) else ln(1 - p_inter + 1e-8) end)), 6) as bce,
          round(coalesce(avg(power(p_rating - y, 2)) filter (where y > 0), 0), 6) as masked_mse,
          count(*) filter (where p_rating * 4.0 + 1.0 >= 3.5 and y * 4.0 + 1.0 >= 3.5) as tp,
          count(*) filter (where p_rating * 4.0 + 1.0 >= 3.5 and y * 4.0 + 1.0 < 3.5) as fp,
          count(*) filter (where p_rating * 4.0 + 1.0 < 3.5 and y * 4.0 + 1.0 >= 3.5) as fn,
          count(*) filter (where p_rating * 4.0 + 1.0 < 3.5 and y * 4.0 + 1.0 < 3.5) as tn
        from fx_evaluation group by model, dataset""",
    "fx_rates": """
        select *, round((tp + tn) / (tp + fp + fn + tn + 1e-8), 6) as accuracy,
          round(tp / (tp + fp + 1e-8), 6) as precision, round(tp / (tp + fn + 1e-8), 6) as recall,
          round(2 * (tp / (tp + fp + 1e-8)) * (tp / (tp + fn + 1e-8))
            / (tp / (tp + fp + 1e-8) + tp / (tp + fn + 1e-8) + 1e-8), 6) as f1
        from fx_pointwise""",
    "fx_at_k": """
        select model, dataset, round(avg(case when chosen > 0 then hits / chosen else 0 end), 6) as precision_at_k,
          round(avg(hits / relevant), 6) as recall_at_k, count(*) as users
        from (select model, dataset, user_id, count(*) filter (where y * 4.0 + 1.0 >= 3.5) as relevant,
            count(*) filter (where rn <= 10 and p_rating * 4.0 + 1.0 >= 3.5) as chosen,
            count(*) filter (where rn <= 10 and p_rating * 4.0 + 1.0 >= 3.5 and y * 4.0 + 1.0 >= 3.5) as hits
          from (select *, row_number() over (partition by model, dataset, user_id order by p_rating desc, item_id) as rn
            from fx_evaluation)
          group by model, dataset, user_id)
        where relevant > 0 group by model, dataset""",
    "fx_ranking": """
        select model, 'test' as dataset, round(avg(case when rank < 10 then 1.0 else 0.0 end), 6) as hit_rate_at_k,
          round(avg(case when rank < 10 then 1.0 / log2(rank + 2) else 0.0 end), 6) as ndcg_at_k,
          count(*) as total_evaluations
        from fx_ranks group by model""",
    "fx_summary": """
        select p.model, p.rmse_stars, r.hit_rate_at_k, r.ndcg_at_k, k.precision_at_k, k.recall_at_k
        from fx_pointwise p join fx_at_k k on p.model = k.model and p.dataset = k.dataset
        join fx_ranking r on p.model = r.model and p.dataset = r.dataset
        where p.dataset = 'test'""",
    "fx_scores": """
        select *, round(0.40::double * ndcg_at_k + 0.25::double * hit_rate_at_k
          + 0.20::double * greatest(0.0::double, 1.0 - rmse_stars / 4.0) + 0.15::double * precision_at_k, 6) as score
        from fx_summary""",
    "fx_parsed": """
        select job, seq, try_cast(regexp_extract(trim(message), '^Epoch (\\d+)', 1) as bigint) as epoch,
          try_cast(regexp_extract(message, 'train_total_loss=([0-9.]+);', 1) as double) as train_total,
          try_cast(regexp_extract(message, 'train_bce=([0-9.]+);', 1) as double) as train_bce,
          try_cast(regexp_extract(message, 'train_mse=([0-9.]+);', 1) as double) as train_mse,
          try_cast(regexp_extract(message, 'lr=([0-9.eE+\\-]+);', 1) as double) as lr
        from fx_logs where trim(message) like 'Epoch %'""",
    "fx_values": """
        select job, seq, metric, value from (
          select job, seq, 'train_total' as metric, train_total as value from fx_parsed
          union all select job, seq, 'train_bce', train_bce from fx_parsed
          union all select job, seq, 'lr', lr from fx_parsed
          union all select job, seq, m.metric, try_cast(regexp_extract(trim(message), '^' || m.metric || '=([0-9.]+);$', 1) as double)
            from fx_logs, (select unnest(['train_mse', 'val_mse', 'val_rmse_stars']) as metric) m
            where not contains(message, 'test_bce=') and trim(message) not like 'Epoch %')
        where value is not null""",
    "fx_placed": """
        select *, row_number() over (partition by job, metric order by seq) as epoch from fx_values""",
    "fx_series": """
        select job, epoch, max(value) filter (where metric = 'train_total') as train_total,
          max(value) filter (where metric = 'train_bce') as train_bce,
          max(value) filter (where metric = 'train_mse') as train_mse,
          max(value) filter (where metric = 'val_mse') as val_mse,
          max(value) filter (where metric = 'val_rmse_stars') as val_rmse_stars,
          max(value) filter (where metric = 'lr') as lr
        from fx_placed group by job, epoch""",
    "fx_aligned": """
        select s.* from fx_series s join (
          select job, least(count(train_total), count(train_bce), count(train_mse), count(val_mse), count(val_rmse_stars)) as n
          from fx_series group by job) l on s.job = l.job
        where s.epoch <= l.n""",
}
