"""SQL that gives the same result as a registered query, for an independent engine."""

from __future__ import annotations

DIRTY = """dirty as (
  select o_orderkey as id,
    case when o_orderkey % 7 = 0 then '?' else floor(o_totalprice)::bigint::varchar end as f1,
    case when o_orderkey % 5 = 0 then (o_custkey % 100)::varchar else '?' end as f2,
    case when o_orderkey % 11 = 0 then '?' else o_custkey::varchar end as f3,
    o_orderstatus as target
  from orders)"""

NULLED = f"""{DIRTY}, nulled as (
  select id, nullif(f1, '?') as f1, nullif(f2, '?') as f2, nullif(f3, '?') as f3, target from dirty)"""

CLEANED = f"""{NULLED}, cleaned as (
  select id, try_cast(f1 as integer) as f1, try_cast(f2 as integer) as f2, try_cast(f3 as integer) as f3, target
  from nulled)"""


def bucket(key: str, seed: int, buckets: int = 10000) -> str:
    return f"(('0x' || substr(md5({key}::varchar || '|{seed}'), 1, 8))::bigint % {buckets})"


def three_way(key: str) -> str:
    return f"""case when {bucket(key, 42)} < 1000 then 'test'
      when {bucket(key, 666)} < 1000 then 'val' else 'train' end"""


def two_way(key: str) -> str:
    return f"case when {bucket(key, 2023)} < 8000 then 'train' else 'test' end"


SCORED = f"""scored as (
  select o_orderkey as id, (o_orderstatus = 'F')::integer as label, o_totalprice as score,
    floor(o_totalprice / 100000) as tied_score, (o_totalprice > 250000)::integer as pred,
    o_orderkey % 3 + 1 as w, {three_way('o_orderkey')} as split
  from orders)"""

CLASSIFIED = """classified as (
  select o_orderstatus as label,
    case when o_totalprice > 250000 then 'F' when o_totalprice > 50000 then 'O' else 'P' end as prediction
  from orders)"""

CLASSIFIED_NULLS = """nulled as (
  select case when o_orderkey % 7 <> 0 then o_orderstatus end as label,
    case when o_orderkey % 11 <> 0 then
      case when o_totalprice > 250000 then 'F' when o_totalprice > 50000 then 'O' else 'P' end end as prediction
  from orders)"""

PAIRS = f"""{CLASSIFIED}, classes as (
  select label as c from classified union select prediction from classified), pairs as (
  select a.c as label, b.c as prediction,
    (select count(*) from classified k where k.label = a.c and k.prediction = b.c) as n
  from classes a cross join classes b)"""

CLASS_STATS = f"""{CLASSIFIED}, classes as (
  select label as c from classified union select prediction from classified), stats as (
  select c, count(*) filter (where label = c and prediction = c)::double as tp,
    count(*) filter (where label <> c and prediction = c)::double as fp,
    count(*) filter (where label = c and prediction <> c)::double as fn,
    count(*) filter (where label = c)::double as support
  from classes cross join classified group by c)"""


def roc(score: str = "score", by: str | None = None) -> str:
    key = f"{by}, " if by else ""
    part = f"partition by {by} " if by else ""
    return f"""{SCORED}, points as (
  select {key}{score} as threshold, sum(label)::double as pos, sum(1 - label)::double as neg
  from scored group by {key}{score}), cum as (
  select *, sum(pos) over ({part}order by threshold desc) as cp, sum(neg) over ({part}order by threshold desc) as cn,
    sum(pos) over ({part}) as tp, sum(neg) over ({part}) as tn
  from points)"""


def value_bins(score: str = "score", n: int = 10) -> str:
    shares = ", ".join(str(k / n) for k in range(n + 1))
    return f"""edges as (select distinct unnest(quantile_cont({score}, [{shares}])) as e from scored), binned as (
  select *, greatest(0, (select count(*) from edges where e < scored.{score}) - 1)::integer as bin from scored)"""


def rank_bins(score: str = "score", n: int = 10, by: str | None = None) -> str:
    part = f"partition by {by} " if by else ""
    return f"""ranked as (
  select *, row_number() over ({part}order by {score}, id) as r, count(*) over ({part}) as total from scored), binned as (
  select *, greatest(0, ((r - 1) * {n} + total - 2) // (total - 1) - 1)::integer as bin from ranked)"""


def weighted_bins(score: str = "score", n: int = 10) -> str:
    return f"""run as (
  select *, sum(w) over (order by {score}, id rows unbounded preceding) as cum, sum(w) over () as total
  from scored), binned as (select *, least({n - 1}, cum * {n} // total)::integer as bin from run)"""


def summary(weight: str = "1", by: str | None = None, n: int = 10) -> str:
    """One row per bin, the highest scores first, with lift and gain."""
    key = f"{by}, " if by else ""
    part = f"partition by {by} " if by else ""
    return f"""sums as (
  select {key}({n} - bin)::integer as bin, sum(label * {weight})::double as wp, sum({weight})::double as ws,
    sum(label)::bigint as positives
  from binned group by {key}bin), lifted as (
  select {key}bin, positives, sum(wp) over ({part}) / sum(ws) over ({part}) as baseline, wp / ws as lift,
    (wp / ws) / (sum(wp) over ({part}) / sum(ws) over ({part})) as lift_index,
    sum(positives) over ({part}order by bin)::double / sum(positives) over ({part}) as gain,
    row_number() over ({part}order by bin) as k, count(*) over ({part}) as n
  from sums)"""


def padded(by: str | None = None) -> str:
    key = f"{by}, " if by else ""
    same = f"l.{by} = d.{by} and " if by else ""
    same_g = f"g.{by} = d.{by} and " if by else ""
    pick = f"d.{by}, " if by else ""
    return f"""deciles as (
  select distinct {key}baseline, unnest(range(0, n + 1)) as d from lifted)
select {pick}d.d::integer as deciles, round(d.baseline, 6) as baseline_percentage,
  round(coalesce(l.lift, 0), 6) as lift_percentage, round(coalesce(l.lift_index, 0), 6) as lift_index,
  round(coalesce(g.gain, 0), 6) as gain, 1 as baseline_index, 1 as random
from deciles d left join lifted l on {same}l.k = d.d + 1 left join lifted g on {same_g}g.k = d.d"""


CUSTOMERS = f"""{SCORED}, bought as (
  select s.*, o_custkey as customer from scored s join orders on o_orderkey = s.id)"""

def corners(score: str = "score", by: str | None = None) -> str:
    key = f"{by}, " if by else ""
    part = f"partition by {by} " if by else ""
    return f"""with {roc(score, by)}, followed as (
  select *, lead(pos) over w as np, lead(neg) over w as nn, row_number() over w as k
  from cum window w as ({part}order by threshold desc))
select {key}threshold, round(cn / tn, 6) as fpr, round(cp / tp, 6) as tpr from followed
where k = 1 or np is null or np <> pos or nn <> neg
union all select {key}null, 0.0, 0.0 from followed where k = 1"""


TEST_DOCUMENTS = f"""select doc_id as id from documents join labels using (doc_id)
where {two_way('doc_id')} = 'test'"""

LABELLED = f"""labelled as (
  select doc_id, {two_way('doc_id')} as side, (dense_rank() over (order by seen desc, quality) - 1)::double as label
  from (select doc_id, quality, count(*) over (partition by quality) as seen from documents join labels using (doc_id)))"""

ORACLES = {
    "quantile_bins_by_order": """with edges as (
  select l_orderkey, list_distinct(quantile_cont(l_extendedprice, [0.0, 0.25, 0.5, 0.75, 1.0])) as e
  from lineitem group by l_orderkey)
select l_orderkey, l_linenumber, l_extendedprice as score,
  greatest(0, len(list_filter(e, lambda x: x < l_extendedprice)) - 1)::integer as bin
from lineitem join edges using (l_orderkey)""",
    "rank_bins_by_customer": f"""with {CUSTOMERS}, ranked as (
  select customer, id, row_number() over w as r, count(*) over (partition by customer) as total
  from bought window w as (partition by customer order by tied_score, id))
select customer, id, case when total = 1 then 0 else greatest(0, ((r - 1) * 4 + total - 2) // (total - 1) - 1) end::integer as bin
from ranked""",
    "weighted_bins_by_customer": f"""with {CUSTOMERS}, run as (
  select customer, id, sum(w) over (partition by customer order by tied_score, id rows unbounded preceding) as cum,
    sum(w) over (partition by customer) as total from bought)
select customer, id, least(3, cum * 4 // total)::integer as bin from run""",
    "set_bins_narrowed": f"with {SCORED}, {rank_bins(by='split')} select split, id, bin from binned",
    "csv_scan": """select p_partkey as feature_1, p_name as feature_2, p_brand as feature_3, p_type as feature_4,
  p_size as feature_5, p_retailprice as target from part""",
    "sentinel_to_null": f"with {NULLED} select * from nulled",
    "cast_columns": f"""with {NULLED} select id, try_cast(f1 as integer) as f1, try_cast(f2 as integer) as f2,
  try_cast(f3 as double) as f3, target from nulled""",
    "null_profile": f"""with {NULLED}
select 'id' as column_name, count(*) filter (where id is null) as nulls, count(*) as total from nulled
union all select 'f1', count(*) filter (where f1 is null), count(*) from nulled
union all select 'f2', count(*) filter (where f2 is null), count(*) from nulled
union all select 'f3', count(*) filter (where f3 is null), count(*) from nulled
union all select 'target', count(*) filter (where target is null), count(*) from nulled""",
    "drop_sparse_columns": f"with {CLEANED} select id, f1, f3, target from cleaned",
    "impute_median": f"""with {NULLED}, numbers as (
  select id, try_cast(f1 as double) as f1, try_cast(f3 as double) as f3, target from nulled)
select id, round(coalesce(f1, (select median(f1) from numbers)), 6) as f1,
  round(coalesce(f3, (select median(f3) from numbers)), 6) as f3, target from numbers""",
    "impute_nan": """with numbers as (
  select o_orderkey as id, case when o_orderkey % 3 <> 0 then o_totalprice end as f1 from orders)
select id, round(coalesce(f1, (select quantile_cont(f1, 0.5) from numbers)), 6) as f1 from numbers""",
    "medians_wide": """select i::integer as position, round(quantile_cont(e::double, 0.5), 6) as median
from (select unnest(range(64)) as i, unnest(embedding[1:64]) as e from embeddings) group by i""",
    "impute_median_disc": f"""with {CLEANED}
select id, coalesce(f1, (select quantile_disc(f1, 0.5) from cleaned)) as f1,
  coalesce(f3, (select quantile_disc(f3, 0.5) from cleaned)) as f3, target from cleaned""",
    "median_within_error": f"with {CLEANED} select count(f1) > 0 as f1, count(f3) > 0 as f3 from cleaned",
    "binarize_label": """select o_orderkey as id, case when o_orderstatus = 'F' then 0 else 1 end as target
from orders""",
    "project_features": "select o_custkey, o_totalprice, o_orderstatus from orders",
    "hash_split": f"select o_orderkey as id, {two_way('o_orderkey')} as split from orders",
    "random_split_union": "select o_orderkey as id from orders",
    "three_way_split": f"select o_orderkey as id, {three_way('o_orderkey')} as split from orders",
    "kfold_assign": f"select o_orderkey as id, {bucket('o_orderkey', 2023, 5)}::integer as fold from orders",
    "label_index": """select o_orderpriority as label,
  (row_number() over (order by count(*) desc, o_orderpriority) - 1)::double as label_index
from orders group by o_orderpriority""",
    "label_encode": """with idx as (
  select o_orderpriority, (row_number() over (order by count(*) desc, o_orderpriority) - 1)::double as label
  from orders group by o_orderpriority)
select o_orderkey as id, o_orderpriority, label from orders join idx using (o_orderpriority)""",
    "assemble_features": """select l_orderkey, l_returnflag, l_quantity as x1, l_extendedprice as x2,
  l_discount as x3, l_tax as x4, l_linenumber::double as x5 from lineitem""",
    "prepare_data": f"""with idx as (
  select o_orderstatus, (row_number() over (order by count(*) desc, o_orderstatus) - 1)::double as label
  from orders group by o_orderstatus)
select o_orderkey as id, {two_way('o_orderkey')} as split, label, o_custkey::double as x1, o_totalprice as x2
from orders join idx using (o_orderstatus)""",
    "balanced_weights": """select o_orderkey as id, o_orderstatus as label,
  round((select count(*) from orders)
    / ((select count(distinct o_orderstatus) from orders) * count(*) over (partition by o_orderstatus)), 6)
    as class_weight
from orders""",
    "search_space": """select p_brand as brand, i::integer as step,
  round_even(min(p_size) + i * ((max(p_size) - min(p_size)) / 4.0::double), 0)::integer as value
from part cross join generate_series(0, 4) as g(i) group by p_brand, i""",
    "param_grid": """with s as (
  select p_brand as brand, min(p_size) as s0, max(p_size) as s1, min(floor(p_retailprice)) as p0,
    max(floor(p_retailprice)) as p1, min(p_size) as l0, max(length(p_name)) as l1
  from part group by p_brand)
select brand, round_even(s0 + i * ((s1 - s0) / 4.0::double), 0)::integer as size,
  round_even(p0 + j * ((p1 - p0) / 2.0::double), 0)::integer as price,
  round_even(l0 + k * (l1 - l0)::double, 0)::integer as length
from s cross join generate_series(0, 4) as a(i) cross join generate_series(0, 2) as b(j)
  cross join generate_series(0, 1) as c(k)""",
    "multiclass_metrics": f"""with {CLASS_STATS}
select round(sum(tp) / sum(support), 6) as accuracy,
  round(sum(support * case when tp + fp > 0 then tp / (tp + fp) else 0 end) / sum(support), 6) as weighted_precision,
  round(sum(support * case when tp + fn > 0 then tp / (tp + fn) else 0 end) / sum(support), 6) as weighted_recall,
  round(sum(support * case when tp > 0 then 2 * tp / (2 * tp + fp + fn) else 0 end) / sum(support), 6) as weighted_f1
from stats""",
    "confusion_matrix": f"""with {PAIRS}
select label, sum(n) filter (where prediction = 'F')::bigint as "predicted_F",
  sum(n) filter (where prediction = 'O')::bigint as "predicted_O",
  sum(n) filter (where prediction = 'P')::bigint as "predicted_P"
from pairs group by label""",
    "confusion_pairs": f"with {PAIRS} select label, prediction, n from pairs",
    "confusion_nulls": f"""with {CLASSIFIED_NULLS}, labels as (
  select label as c from nulled union select prediction from nulled)
select c as label, count(*) filter (where prediction = 'F') as "predicted_F",
  count(*) filter (where prediction = 'O') as "predicted_O", count(*) filter (where prediction = 'P') as "predicted_P",
  count(*) filter (where prediction is null and hit) as predicted_null
from labels left join (select *, true as hit from nulled) on label is not distinct from c group by c""",
    "confusion_other": f"""with {CLASSIFIED_NULLS}, labels as (
  select label as c from nulled union select prediction from nulled)
select c as label, count(*) filter (where prediction = 'F') as "predicted_F",
  count(*) filter (where hit and prediction is distinct from 'F') as predicted_other
from labels left join (select *, true as hit from nulled) on label is not distinct from c group by c""",
    "metrics_nulls": f"""with {CLASSIFIED_NULLS}, classified as (
  select coalesce(label, '-') as label, coalesce(prediction, '-') as prediction from nulled), classes as (
  select label as c from classified union select prediction from classified), stats as (
  select c, count(*) filter (where label = c and prediction = c)::double as tp,
    count(*) filter (where label <> c and prediction = c)::double as fp,
    count(*) filter (where label = c and prediction <> c)::double as fn,
    count(*) filter (where label = c)::double as support
  from classes cross join classified group by c)
select round(sum(tp) / sum(support), 6) as accuracy,
  round(sum(support * case when tp + fp > 0 then tp / (tp + fp) else 0 end) / sum(support), 6) as weighted_precision,
  round(sum(support * case when tp + fn > 0 then tp / (tp + fn) else 0 end) / sum(support), 6) as weighted_recall,
  round(sum(support * case when tp > 0 then 2 * tp / (2 * tp + fp + fn) else 0 end) / sum(support), 6) as weighted_f1
from stats""",
    "recall_by_split": f"""with {SCORED}
select split, round(count(*) filter (where label = 1 and pred = 1)::double
  / count(*) filter (where label = 1), 6) as recall
from scored group by split""",
    "penalized_objective": f"""with {SCORED}, r as (
  select count(*) filter (where split = 'train' and label = 1 and pred = 1)::double
      / count(*) filter (where split = 'train' and label = 1) as t,
    count(*) filter (where split = 'val' and label = 1 and pred = 1)::double
      / count(*) filter (where split = 'val' and label = 1) as v
  from scored)
select round(t, 6) as train_recall, round(v, 6) as validation_recall, round(v - abs(t - v), 6) as objective from r""",
    "roc_curve": f"""with {roc()}
select threshold, round(cn / tn, 6) as fpr, round(cp / tp, 6) as tpr from cum
union all select null, 0.0, 0.0""",
    "roc_by_split": f"""with {roc(by='split')}
select split, threshold, round(cn / tn, 6) as fpr, round(cp / tp, 6) as tpr from cum
union all select distinct split, null, 0.0, 0.0 from cum""",
    "roc_auc": f"with {roc()} select round(sum(neg * (cp - pos / 2)) / (max(tp) * max(tn)), 6) as auc from cum",
    "auc_by_split": f"""with {roc(by='split')}
select split, round(sum(neg * (cp - pos / 2)) / (max(tp) * max(tn)), 6) as auc from cum group by split""",
    "hard_auc_by_split": f"""with {roc('pred', 'split')}
select split, round(sum(neg * (cp - pos / 2)) / (max(tp) * max(tn)), 6) as auc from cum group by split""",
    "roc_pieces": f"""with {roc()}
select threshold, round(cn / tn, 6) as fpr, round(cp / tp, 6) as tpr from cum
union all select null, 0.0, 0.0""",
    "auc_pieces_by_split": f"""with {roc(by='split')}
select split, round(sum(neg * (cp - pos / 2)) / (max(tp) * max(tn)), 6) as auc from cum group by split""",
    "bins_narrowed": f"with {SCORED}, {value_bins()} select id, bin from binned",
    "tied_bins_narrowed": f"with {SCORED}, {rank_bins('tied_score')} select id, bin from binned",
    "weighted_bins_narrowed": f"with {SCORED}, {weighted_bins('tied_score')} select id, bin from binned",
    "decimal_id_bins": f"with {SCORED}, {rank_bins('tied_score')} select id, bin from binned",
    "quantile_bins": f"with {SCORED}, {value_bins()} select id, bin from binned",
    "rank_bins": f"with {SCORED}, {rank_bins()} select id, bin from binned",
    "tied_score_bins": f"with {SCORED}, {rank_bins('tied_score')} select id, bin from binned",
    "weighted_bins": f"with {SCORED}, {weighted_bins()} select id, bin from binned",
    "tied_weighted_bins": f"with {SCORED}, {weighted_bins('tied_score')} select id, bin from binned",
    "lift_table": f"""with {SCORED}, {weighted_bins()}, {summary('w')}
select bin, round(baseline, 6) as baseline_percentage, round(lift, 6) as lift_percentage,
  round(lift_index, 6) as lift_index from lifted""",
    "gain_table": f"with {SCORED}, {value_bins()}, {summary()} select bin, positives, round(gain, 6) as gain from lifted",
    "lift_gain_table": f"with {SCORED}, {value_bins()}, {summary()}, {padded()}",
    "lift_by_split": f"with {SCORED}, {rank_bins('pred', by='split')}, {summary(by='split')}, {padded('split')}",
    "lift_null_set": f"""with {SCORED.replace(three_way('o_orderkey'), f"nullif({three_way('o_orderkey')}, 'test')")},
{rank_bins('pred', by='split')}, {summary(by='split')}
select split, bin, round(baseline, 6) as baseline_percentage, round(lift, 6) as lift_percentage,
  round(lift_index, 6) as lift_index from lifted""",
    "top_scored_row": f"with {SCORED} select id, label, score from scored order by score desc, id limit 1",
    "top_contributions": """with c as (
  select vec_id as id, unnest(range(0, len(embedding))) as i, unnest(embedding)::double as c from embeddings), r as (
  select *, row_number() over (partition by id order by abs(c) desc, i) as k from c)
select id, k::integer as position, i::varchar as feature, round(c, 6) as contribution from r where k <= 5
union all select id, 6, 'others', round(sum(c), 6) from r where k > 5 group by id""",
    "mean_abs_contribution": """with c as (
  select unnest(range(0, len(embedding))) as i, unnest(embedding)::double as c from embeddings)
select i::varchar as feature, round(avg(abs(c)), 6) as mean_abs from c group by i order by avg(abs(c)) desc, i limit 8""",
    "feature_list_roundtrip": f"""with {CLEANED}, shares as (
  select 0 as p, 'id' as f, count(*) filter (where id is null) as n, count(*) as total from cleaned
  union all select 1, 'f1', count(*) filter (where f1 is null), count(*) from cleaned
  union all select 2, 'f2', count(*) filter (where f2 is null), count(*) from cleaned
  union all select 3, 'f3', count(*) filter (where f3 is null), count(*) from cleaned)
select (row_number() over (order by p) - 1)::integer as position, f as selected_features
from shares where n <= 0.5 * total""",
    "hyperparameters_roundtrip": """with v as (
  select count(distinct o_orderpriority) + 3 as t, count(distinct o_orderstatus) + 1 as d,
    greatest(3, floor(avg(o_totalprice) / 10000))::bigint as b from orders)
select 'numTrees' as param, t::varchar as value from v
union all select 'maxDepth', d::varchar from v union all select 'maxBins', b::varchar from v""",
    "forest_probabilities": f"select id, 1.0::double as total, true as likely from ({TEST_DOCUMENTS})",
    "importance_of_constant": "select 7::bigint as features, 1.0::double as total, 0.0::double as constant from labels limit 1",
    "shadow_rejects": """select 'constant' as feature, 0 as hits, 8 as trials, 'rejected' as decision, 0.0::double as importance
from labels limit 1""",
    "grid_search_shape": """select '{"maxDepth": ' || d || ', "numTrees": ' || t || '}' as params, 3 as folds, true as in_range
from (values (2), (5)) as a(d), (values (3), (9)) as b(t)""",
    "random_search_sets": f"""with {LABELLED}
select i::integer as trial, case side when 'test' then 'validation' else side end as set, label, count(*) as n
from labelled, range(4) as t(i) group by i, side, label""",
    "grid_search_folds": f"""with {LABELLED}
select '{{"maxDepth": ' || d || ', "numTrees": ' || t || '}}' as params, {bucket('doc_id', 2023, 3)}::integer as fold, label, count(*) as n
from labelled, (values (2), (5)) as a(d), (values (3), (9)) as b(t) where side = 'train' group by all""",
    "grid_search_majority": f"""with {LABELLED}, folded as (
  select label, {bucket('doc_id', 2023, 3)}::integer as fold from labelled where side = 'train'), sizes as (
  select f as fold, label, count(*) filter (where fold <> f) as others, count(*) filter (where fold = f)::double as own
  from folded, range(3) as r(f) group by f, label), scores as (
  select fold::integer as fold, arg_max(own, others) as hit, sum(own) as n from sizes group by fold), each as (
  select fold, hit / n * 2 * hit / (hit + n) as fold_score from scores)
select i::integer as trial, fold, round(fold_score, 6) as fold_score, round(avg(fold_score) over (partition by i), 6) as score
from each, range(2) as t(i)""",
    "class_attributions": """select doc_id as id, c::integer as class, true as adds_up
from documents join labels using (doc_id), range((select count(distinct lang) from documents join labels using (doc_id))) as t(c)""",
    "roc_corners": corners("tied_score"),
    "roc_corners_pieces": corners(by="split"),
    "inferred_csv": """select o_orderkey::integer as feature_1, case when o_orderkey % 7 <> 0 then o_custkey::integer end as feature_2,
  case when o_orderkey % 11 <> 0 then o_orderkey * 10000000000 end as feature_3,
  case when o_orderkey % 5 <> 0 then o_totalprice::decimal(18, 2)::double end as feature_4,
  case when o_orderkey % 3 <> 0 then o_orderpriority end as feature_5, null::varchar as feature_6,
  (o_orderstatus = 'F')::integer as target, 'int,int,bigint,double,string,string,int' as kinds from orders""",
    "best_parameters": "select unnest(['maxDepth', 'numTrees']) as param, true as of_best, true as refitted",
    "staged_totals": f"""with {LABELLED}
select stage::integer as n_estimators, label, count(*) as n
from labelled, (values (1), (2), (4), (8), (12)) as s(stage) where side = 'test' group by stage, label""",
    "boosted_probabilities": f"select id, 1.0::double as total, true as likely from ({TEST_DOCUMENTS})",
    "elimination_of_constant": "select 0::bigint as constant, true as enough",
    "training_stages": """with s as (
  select unnest(['cleaned', 'selected_features', 'hyperparameters', 'final_model']) as stage)
select 0 as run, stage, 'built' as state from s
union all select 1, stage, 'reused' from s
union all select 2, stage, case stage when 'cleaned' then 'reused' else 'rebuilt' end from s""",
    "random_search_shape": "select i::integer as trial, 9 as parameters, true as in_range from range(4) as t(i)",
    "training_totals": f"""with d as (
  select doc_id, quality from documents join labels using (doc_id)), idx as (
  select quality, (row_number() over (order by count(*) desc, quality) - 1)::double as label from d group by quality)
select label, count(*)::bigint as n from d join idx using (quality) where {two_way('doc_id')} = 'test' group by label""",
    "model_roundtrip": f"select id, true as unchanged from ({TEST_DOCUMENTS})",
    "attribution_adds_up": f"select id, true as adds_up from ({TEST_DOCUMENTS})",
}
