"""DuckDB SQL oracles for the registered queries.

Each string runs on the test tables registered as views (events, orders,
lineitem, part, embeddings, ...) and must give the same rows, column names and
types as the Spark query of the same key.  They are written independently of
the Spark plans where SQL allows (windows where Spark uses aggregates, IN
subqueries where Spark uses semi joins, intersect for overlaps).
"""

from __future__ import annotations

K = 100
DIGITS = 9

# ------------------------------------------------------------------ fixtures
F1_LOG = """select user_id, cast(json_extract_string(props, '$.k') as bigint) as recording_msid,
       ts as "timestamp" from events"""

F1_TRACKS = f"""select distinct recording_msid,
       case when recording_msid % 10 < 7 then cast(recording_msid // 4 as varchar) end as recording_mbid,
       cast(null as varchar) as artist_name, cast(recording_msid as varchar) as track_name
  from ({F1_LOG})"""

F1W = """select user_id, cast(json_extract_string(props, '$.k') as bigint) as recording_msid,
       cast(round(sum(cast(value as decimal(12, 2))), 0) as bigint) as listens
  from events group by 1, 2"""

F2_LOG = """select o.o_custkey as user_id, l.l_partkey as recording_msid, l.l_shipdate as "timestamp"
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey"""

F2_TRACKS = """select p_partkey as recording_msid, case when p_size > 10 then p_name end as recording_mbid,
       p_brand as artist_name, p_name as track_name from part"""


def H(salt: str, *keys: str) -> str:
    """The split hash: first 8 hex digits of md5(salt || k1 || ':' || k2 ...) / 2^32."""
    text = " || ':' || ".join(f"cast({k} as varchar)" for k in keys)
    return f"(cast(('0x' || substr(md5('{salt}' || {text}), 1, 8)) as bigint) / 4294967296.0)"


def canonical_log(log: str, tracks: str, dedupe: bool = True) -> str:
    """Rows of the log with the mbid's first msid (by timestamp, msid); the
    mbid branch de-duplicated on (user, timestamp, item) when asked."""
    mb = "select distinct user_id, recording_msid, \"timestamp\" from mb" if dedupe else \
         "select user_id, recording_msid, \"timestamp\" from mb"
    return f"""
    with j as (select l.user_id, l.recording_msid, l."timestamp", t.recording_mbid
                 from ({log}) l join ({tracks}) t using (recording_msid)),
         mb as (select user_id, "timestamp",
                       first_value(recording_msid) over (partition by recording_mbid
                                                         order by "timestamp", recording_msid) as recording_msid
                  from j where recording_mbid is not null)
    {mb}
    union all
    select user_id, recording_msid, "timestamp" from j where recording_mbid is null"""


def counts_of(log: str) -> str:
    return f"""select user_id, recording_msid, count("timestamp") as listens from ({log}) group by 1, 2"""


CANON_F1 = counts_of(canonical_log(F1_LOG, F1_TRACKS))
CANON_F2 = counts_of(canonical_log(F2_LOG, F2_TRACKS))
CANON_F2_NODEDUPE = counts_of(canonical_log(F2_LOG, F2_TRACKS, dedupe=False))


def r(expr: str, name: str) -> str:
    return f"round({expr}, {DIGITS}) as {name}"


# ------------------------------------------------------------------ popularity
def popularity_eval(model: str, per_user: bool = False, log: str = F2_LOG) -> str:
    score = "count(*)" if model == "total" else "cast(count(*) as double) / count(distinct user_id)"
    pu = f"""
    with s as (select *, {H('u:', 'user_id')} < 0.6 as is_train from ({log})),
         tr as (select recording_msid, {score} as score from s where is_train group by 1),
         top as (select * from (select recording_msid,
                                       row_number() over (order by score desc, recording_msid) as pos
                                  from tr) where pos <= {K}),
         vc as (select user_id, recording_msid, count(*) as listens from s where not is_train group by 1, 2),
         truth as (select user_id, recording_msid from (
                     select *, row_number() over (partition by user_id order by listens desc, recording_msid) as rn
                       from vc) where rn <= {K}),
         hits as (select t.user_id, p.pos, row_number() over (partition by t.user_id order by p.pos) as rnk
                    from truth t join top p using (recording_msid)),
         hu as (select user_id, sum(rnk / pos) as ap_sum, sum(1.0 / ln(pos + 1)) as dcg, count(*) as nh
                  from hits group by 1),
         tu as (select user_id, count(*) as nt from truth group by 1),
         pu as (select tu.user_id, nt as n_truth, coalesce(nh, 0) as n_hits,
                       coalesce(ap_sum, 0) / least(nt, {K}) as ap,
                       coalesce(dcg, 0) / list_sum(list_transform(range(1, least(nt, {K}) + 1),
                                                                  lambda j: 1.0 / ln(j + 1))) as ndcg,
                       cast(coalesce(nh, 0) as double) / {K} as "precision",
                       cast(coalesce(nh, 0) as double) / nt as recall
                  from tu left join hu using (user_id))"""
    if per_user:
        return pu + f"""
    select user_id, n_truth, n_hits, {r('ap', 'ap')}, {r('ndcg', 'ndcg')},
           {r('"precision"', '"precision"')}, {r('recall', 'recall')} from pu"""
    return pu + f"""
    select {r('avg(ap)', 'map_at_k')}, {r('avg(ndcg)', 'ndcg_at_k')}, {r('avg("precision")', 'precision_at_k')},
           {r('avg(recall)', 'recall_at_k')}, count(*) as n_users from pu"""


def top_by(score: str, log: str) -> str:
    return f"""
    select cast(pos as integer) as pos, recording_msid, score from (
      select recording_msid, {score} as score,
             row_number() over (order by {score} desc, recording_msid) as pos
        from ({log}) group by recording_msid) where pos <= {K}"""


AVG_SCORE = "round(cast(count(*) as double) / count(distinct user_id), 9)"


def popularity_average_top(log: str) -> str:
    return f"""
    select cast(pos as integer) as pos, recording_msid, round(score, {DIGITS}) as score from (
      select recording_msid, cast(count(*) as double) / count(distinct user_id) as score,
             row_number() over (order by cast(count(*) as double) / count(distinct user_id) desc,
                                recording_msid) as pos
        from ({log}) group by recording_msid) where pos <= {K}"""


# ------------------------------------------------------------------ splits
def user_split(src: str, frac: float, holdin: float | None = None) -> str:
    cond = f"{H('u:', 'user_id')} < {frac}"
    if holdin is not None:
        cond += f" or {H('h:', 'user_id', 'recording_msid')} < {holdin}"
    return f"select *, case when {cond} then 'train' else 'val' end as split from ({src})"


def row_split(src: str, frac: float, holdin: float | None = 0.6) -> str:
    cond = f"{H('r:', 'user_id', 'recording_msid')} < {frac}"
    if holdin is not None:
        cond += f" or {H('rh:', 'user_id', 'recording_msid')} < {holdin}"
    return f"select *, case when {cond} then 'train' else 'val' end as split from ({src})"


def overlap(split_sql: str) -> str:
    return f"""
    with s as ({split_sql}),
         tr as (select * from s where split = 'train'), va as (select * from s where split = 'val')
    select (select count(distinct user_id) from tr) as train_users,
           (select count(distinct user_id) from va) as val_users,
           (select count(*) from (select user_id from tr intersect select user_id from va)) as common_users,
           (select count(*) from tr) as train_rows,
           (select count(*) from va) as val_rows,
           (select cast(count_if(listens = 1) as bigint) from tr) as train_listens_eq_1,
           (select cast(count_if(listens = 1) as bigint) from va) as val_listens_eq_1"""


def seen_only(split_sql: str) -> str:
    return f"""
    with s as ({split_sql}),
         tr as (select * from s where split = 'train'),
         va as (select user_id, recording_msid, listens from s where split = 'val')
    select * from va where user_id in (select user_id from tr)
                       and recording_msid in (select recording_msid from tr)"""


def centred(src: str) -> str:
    return f"""
    with rr as ({src}),
         um as (select user_id, avg(listens) as um from rr group by 1),
         im as (select recording_msid, avg(listens) as im from rr group by 1),
         c as (select rr.user_id, rr.recording_msid, rr.listens, rr.listens - um - im as centred
                 from rr join um using (user_id) join im using (recording_msid))
    select user_id, recording_msid, listens, cast(round_even(centred, 0) as bigint) as listens_mean
      from c where centred >= 0"""


def above_median(src: str, offset: int = 3) -> str:
    return f"""with rr as ({src}) select * from rr where listens > (select median(listens) from rr) + {offset}"""


def profile(src: str) -> str:
    return f"""
    select count(*) as n_rows, count(distinct user_id) as n_users, count(distinct recording_msid) as n_items,
           {r('avg(listens)', 'mean_listens')}, min(listens) as min_listens, max(listens) as max_listens,
           {r('median(listens)', 'median_listens')}, quantile_disc(listens, 0.5) as approx_median_listens,
           cast(count_if(listens = 1) as bigint) as n_listens_eq_1
      from ({src})"""


def dense_codes(key: str, src: str, name: str) -> str:
    return f"""
    select {key}, cast(dense_rank() over (order by {key}) - 1 as integer) as {name}
      from (select distinct {key} from ({src}) where {key} is not null)"""


LEFT_F1 = f"""select l.recording_msid, l.user_id, l."timestamp", t.recording_mbid
  from ({F1_LOG}) l left join ({F1_TRACKS}) t using (recording_msid)"""

F1_TRACKS_GAPS = f"select * from ({F1_TRACKS}) where recording_msid % 13 <> 5"

LEFT_GAPS = f"""select l.recording_msid, l.user_id, l."timestamp", t.recording_mbid
  from ({F1_LOG}) l left join ({F1_TRACKS_GAPS}) t using (recording_msid)"""


def canonical_log_left(log: str, tracks: str, both: bool) -> str:
    """As canonical_log, with listens of tracks that the dimension lacks."""
    without = "select distinct user_id, recording_msid, \"timestamp\" from j where recording_mbid is null" if both else \
              "select user_id, recording_msid, \"timestamp\" from j where recording_mbid is null"
    return f"""
    with j as (select l.user_id, l.recording_msid, l."timestamp", t.recording_mbid
                 from ({log}) l left join ({tracks}) t using (recording_msid)),
         mb as (select user_id, "timestamp",
                       first_value(recording_msid) over (partition by recording_mbid
                                                         order by "timestamp", recording_msid) as recording_msid
                  from j where recording_mbid is not null)
    select distinct user_id, recording_msid, "timestamp" from mb
    union all {without}"""


def three_split(src: str) -> str:
    h = H('u:', 'user_id')
    return f"""select *, case when {h} < 0.6 then 'train' when {h} < 0.8 then 'val' else 'test' end as split from ({src})"""


def overlap_three(split_sql: str) -> str:
    parts = ("train", "val", "test")
    users = {p: f"(select distinct user_id from s where split = '{p}')" for p in parts}
    cols = [f"(select count(*) from {users[p]}) as {p}_users" for p in parts]
    cols += [f"(select count(*) from (from {users[a]} intersect from {users[b]})) as common_{a}_{b}"
             for a, b in (("train", "val"), ("train", "test"), ("val", "test"))]
    cols += [f"(select count(*) from s where split = '{p}') as {p}_rows" for p in parts]
    cols += [f"(select count(*) from s where split = '{p}' and listens = 1) as {p}_listens_eq_1" for p in parts]
    return f"with s as ({split_sql}) select " + ", ".join(cols)


def popularity_part(part: str) -> str:
    """Metrics of the total-listens list of the train users on one part."""
    return f"""
    select avg(ap) as map_at_k, avg(ndcg) as ndcg_at_k, avg(p) as precision_at_k, avg(recall) as recall_at_k,
           count(*) as n_users, '{part}' as split from (
      select t.user_id, coalesce(h.ap, 0) / least(nt, {K}) as ap,
             coalesce(dcg, 0) / list_sum(list_transform(range(1, least(nt, {K}) + 1), lambda j: 1.0 / ln(j + 1))) as ndcg,
             coalesce(nh, 0) / {K}.0 as p, cast(coalesce(nh, 0) as double) / nt as recall
        from (select user_id, count(*) as nt from truth where split = '{part}' group by 1) t
        left join (select user_id, sum(rnk / pos) as ap, sum(1.0 / ln(pos + 1)) as dcg, count(*) as nh from (
                     select user_id, pos, row_number() over (partition by user_id order by pos) as rnk
                       from truth join top using (recording_msid) where split = '{part}') group by 1) h
          using (user_id))"""


POPULARITY_VAL_TEST = f"""
    with c as ({three_split(counts_of(F2_LOG))}),
         top as (select * from (select recording_msid, row_number() over (order by sum(listens) desc, recording_msid) as pos
                                  from c where split = 'train' group by 1) where pos <= {K}),
         truth as (select * from (select *, row_number() over (partition by user_id
                                                               order by listens desc, recording_msid) as rn
                                    from c where split <> 'train') where rn <= {K})
    select {r('map_at_k', 'map_at_k')}, {r('ndcg_at_k', 'ndcg_at_k')}, {r('precision_at_k', 'precision_at_k')},
           {r('recall_at_k', 'recall_at_k')}, n_users, split
      from ({popularity_part('val')} union all {popularity_part('test')})"""

FAVOURITES = f"""
    c as ({CANON_F1}),
    rec as (select * from (select user_id, recording_msid, row_number() over (partition by user_id
                                                                              order by recording_msid) as pos
                             from c) where pos <= 10),
    obs as (select user_id, recording_msid from c where listens > 1)"""

def exact_split(log: str, salt: str, *keys: str) -> str:
    """The keys with the least 70 percent (rounded down) of hashes are in train."""
    names = ", ".join(keys)
    return f"""
        select {names}, case when row_number() over (order by h, {names}) <= floor(0.7 * (count(*) over ()) + 1e-9)
                             then 'train' else 'val' end as split
          from (select *, {H(salt, *keys)} as h from (select distinct {names} from ({log})))"""


ORACLE = {
    "attach_left_gaps": LEFT_GAPS,
    "null_profile_gaps": f"""
        select count(*) - count(recording_msid) as nulls_recording_msid, count(*) - count(user_id) as nulls_user_id,
               count(*) - count("timestamp") as nulls_timestamp, count(*) - count(recording_mbid) as nulls_recording_mbid
          from ({LEFT_GAPS})""",
    "canonical_counts_left": counts_of(canonical_log_left(F1_LOG, F1_TRACKS_GAPS, both=False)),
    "canonical_log_both": canonical_log_left(F1_LOG, F1_TRACKS_GAPS, both=True),
    "encoded_left": f"""
        with c as ({CANON_F2}),
             k as (select recording_msid, cast(row_number() over (order by recording_msid) - 1 as integer) as codes
                     from (select recording_msid from c group by 1 having sum(listens) > 2))
        select c.recording_msid, c.user_id, c.listens, k.codes from c left join k using (recording_msid)""",
    "string_ids_top": f"""
        with l as (select user_id, 'msid-' || recording_msid as recording_msid, "timestamp" from ({F2_LOG})),
             t as (select 'msid-' || recording_msid as recording_msid, recording_mbid from ({F2_TRACKS})),
             n as (select recording_msid, sum(listens) as score
                     from ({counts_of(canonical_log('select * from l', 'select * from t'))}) group by 1)
        select cast(pos as integer) as pos, recording_msid, cast(score as bigint) as score from (
          select *, row_number() over (order by score desc, recording_msid) as pos from n) where pos <= {K}""",
    "split_overlap_three": overlap_three(three_split(CANON_F2)),
    "popularity_val_test": POPULARITY_VAL_TEST,
    "rmse_item_mean": f"""
        with s as ({row_split(CANON_F2, 0.7, 0.6)}),
             m as (select recording_msid, avg(listens) as p from s where split = 'train' group by 1)
        select {r('sqrt(avg(power(listens - p, 2)))', 'rmse')}, count(*) as n_scored
          from s join m using (recording_msid) where split = 'val'""",
    "auc_popularity": f"""
        with c as ({CANON_F1}), t as (select recording_msid, sum(listens) as score from c group by 1),
             x as (select score, listens > 1 as rel from c join t using (recording_msid)),
             k as (select rel, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0 as rk from x)
        select count(*) as n_pairs, cast(count_if(rel) as bigint) as n_relevant,
               {r('(sum(rk) filter (rel) - count_if(rel) * (count_if(rel) + 1.0) / 2) / (count_if(rel) * cast(count_if(not rel) as double))', 'auc')}
          from k""",
    "hit_accuracy_lists": f"""
        with {FAVOURITES},
             u as (select user_id, recording_msid, max(r) as r, max(o) as o from (
                     select user_id, recording_msid, 1 as r, 0 as o from rec where user_id in (select user_id from obs)
                     union all select user_id, recording_msid, 0, 1 from obs) group by 1, 2)
        select {r('avg(cast(r + o = 2 as integer))', 'accuracy')}, count(*) as n_pairs from u""",
    "user_list_map": f"""
        with {FAVOURITES},
             n as (select user_id, count(*) as nt from obs group by 1),
             h as (select user_id, sum(rnk / pos) as s, count(*) as nh from (
                     select user_id, pos, row_number() over (partition by user_id order by pos) as rnk
                       from rec join obs using (user_id, recording_msid)) group by 1)
        select {r('avg(coalesce(s, 0) / nt)', 'map_all')}, {r('avg(coalesce(nh, 0) / cast(nt as double))', 'recall')},
               count(*) as n_users from n left join h using (user_id)""",
    "seen_precision_popularity": f"""
        with s as ({row_split(CANON_F2, 0.7, None)}),
             top as (select * from (select recording_msid, row_number() over (order by sum(listens) desc, recording_msid) as pos
                                      from s where split = 'train' group by 1) where pos <= {K}),
             seen as (select user_id, recording_msid from s where split = 'val'
                         and user_id in (select user_id from s where split = 'train')
                         and recording_msid in (select recording_msid from s where split = 'train'))
        select {r('avg(hits) / ' + str(K) + '.0', 'precision_at_k')}, count(*) as n_users from (
          select user_id, count(top.pos) as hits from seen left join top using (recording_msid) group by 1)""",
    "mips_exact_ties": f"""
        with v as (select 'v' || vec_id as id, list_transform(embedding[1:2], lambda x: cast(sign(x) as double)) as e
                     from embeddings)
        select query_id, cast(pos as integer) as pos, item_id, round(score, {DIGITS}) as score from (
          select q.id as query_id, i.id as item_id, list_inner_product(q.e, i.e) as score,
                 row_number() over (partition by q.id order by list_inner_product(q.e, i.e) desc, i.id) as pos
            from v q, v i) where pos <= 10""",
    "popularity_map": popularity_eval("total"),
    "popularity_map_f1": popularity_eval("total", log=F1_LOG),
    "popularity_average_map_f1": popularity_eval("average", log=F1_LOG),
    "popularity_user_metrics": popularity_eval("total", per_user=True),
    "popularity_average_map": popularity_eval("average"),
    "popularity_total_top": top_by("count(*)", F2_LOG),
    "popularity_average_top": popularity_average_top(F2_LOG),
    "popularity_average_top_f1": popularity_average_top(F1_LOG),
    "popularity_list": f"""
        select string_agg(cast(recording_msid as varchar), ',' order by pos) as predicted_recording_msid
          from ({top_by('count(*)', F2_LOG)})""",
    "item_average_listens": f"""
        select recording_msid, count(*) as total_count, count(distinct user_id) as distinct_users,
               {r('cast(count(*) as double) / count(distinct user_id)', 'avg_listens')}
          from ({F2_LOG}) group by 1""",
    "average_two_level": f"""
        select recording_msid, {r('sum(listens) / count(*)', 'avg_listens')}
          from ({counts_of(F2_LOG)}) group by 1""",
    "listen_counts_f1": counts_of(F1_LOG),
    "listen_counts_sql": f"""select user_id, recording_msid, count(*) as total_listens
        from ({F2_LOG}) group by 1, 2""",
    "listen_counts_f2": counts_of(F2_LOG),
    "attach_inner": f"""select l.recording_msid, l.user_id, l."timestamp", t.recording_mbid
        from ({F2_LOG}) l join ({F2_TRACKS}) t using (recording_msid)""",
    "attach_left": LEFT_F1,
    "canonical_map": f"""
        with fs as (select recording_msid, min("timestamp") as first_ts from ({F2_LOG}) group by 1),
             t as ({F2_TRACKS}),
             wm as (select t.recording_msid, t.recording_mbid, fs.first_ts
                      from t join fs using (recording_msid) where t.recording_mbid is not null),
             win as (select distinct recording_mbid,
                            first_value(recording_msid) over (partition by recording_mbid
                                                              order by first_ts, recording_msid) as w from wm)
        select t.recording_msid, t.recording_mbid, coalesce(win.w, t.recording_msid) as canonical_msid
          from t left join win using (recording_mbid)""",
    "canonical_log": canonical_log(F2_LOG, F2_TRACKS),
    "canonical_counts_f2": CANON_F2,
    "canonical_counts_f2_nodedupe": CANON_F2_NODEDUPE,
    "canonical_counts_f1": CANON_F1,
    "item_codes": dense_codes("recording_msid", CANON_F2, "codes"),
    "track_codes": dense_codes("recording_mbid", F2_TRACKS, "mbid_id"),
    "encoded_ratings": f"""
        with c as ({CANON_F2}), k as ({dense_codes('recording_msid', CANON_F2, 'codes')})
        select c.user_id, k.codes as recording_msid, c.listens from c join k using (recording_msid)""",
    "als_matrix_shape": f"""select count(distinct user_id) as n_users, count(distinct recording_msid) as n_items
        from ({CANON_F2})""",
    "prepared_splits": user_split(f"""
        with c as ({CANON_F2}), k as ({dense_codes('recording_msid', CANON_F2, 'codes')})
        select c.user_id, k.codes as recording_msid, c.listens from c join k using (recording_msid)""",
        0.7, 0.6),
    "rating_profile_f1": profile(CANON_F1),
    "rating_profile_f2": profile(CANON_F2),
    "null_profile": f"""
        select cast(count_if(recording_msid is null) as bigint) as nulls_recording_msid, cast(count_if(user_id is null) as bigint) as nulls_user_id,
               cast(count_if("timestamp" is null) as bigint) as nulls_timestamp,
               cast(count_if(recording_mbid is null) as bigint) as nulls_recording_mbid
          from ({LEFT_F1})""",
    "complete_rows": f"""select * from ({LEFT_F1}) where recording_msid is not null and user_id is not null
                           and "timestamp" is not null and recording_mbid is not null""",
    "min_listens": f"select * from ({CANON_F1}) where listens > 1",
    "above_median": above_median(F1W),
    "centered_ratings": centred(above_median(F1W)),
    "centered_all_f2": centred(CANON_F2),
    "user_split": user_split(CANON_F1, 0.6),
    "holdin_split": user_split(CANON_F1, 0.7, 0.6),
    "row_split": row_split(CANON_F1, 0.7, 0.6),
    "split_overlap": overlap(user_split(CANON_F1, 0.7, 0.6)),
    "split_overlap_f2": overlap(user_split(CANON_F2, 0.7, 0.6)),
    "seen_only": seen_only(user_split(CANON_F1, 0.7, 0.6)),
    "seen_only_f2": seen_only(row_split(CANON_F2, 0.7, None)),
    "user_top_k": f"""
        select user_id, recording_msid, listens, cast(rn as integer) as pos from (
          select *, row_number() over (partition by user_id order by listens desc, recording_msid) as rn
            from ({CANON_F2})) where rn <= {K}""",
    "user_truth_lists": f"""
        select user_id, string_agg(cast(recording_msid as varchar), ',' order by rn) as items from (
          select *, row_number() over (partition by user_id order by listens desc, recording_msid) as rn
            from ({counts_of(F2_LOG)})) where rn <= {K} group by 1""",
    "mips_exact": f"""
        select query_id, cast(pos as integer) as pos, item_id, round(score, {DIGITS}) as score from (
          select q.vec_id as query_id, i.vec_id as item_id,
                 list_inner_product(cast(q.embedding as double[]), cast(i.embedding as double[])) as score,
                 row_number() over (partition by q.vec_id
                                    order by list_inner_product(cast(q.embedding as double[]),
                                                                cast(i.embedding as double[])) desc,
                                             i.vec_id) as pos
            from embeddings q, embeddings i) where pos <= 10""",
    "heavy_total_top": top_by("count(*)", F2_LOG),
    "split_overlap_sketches": f"""
        with l as (select user_id, case when {H('r:', 'user_id', 'recording_msid')} < 0.5 then 'train' else 'val' end as split
                     from ({F2_LOG}) where year("timestamp") between 1993 and 1997),
             t as (select distinct user_id from l where split = 'train'),
             v as (select distinct user_id from l where split = 'val')
        select (select count(*) from l where split = 'train') as train_rows,
               (select count(*) from l where split = 'val') as val_rows,
               (select count(*) from t) as train_users, (select count(*) from v) as val_users,
               (select count(*) from t join v using (user_id)) as common_train_val""",
    "exact_split_f2": exact_split(F2_LOG, "u:", "user_id"),
    "exact_row_split_f1": exact_split(F1_LOG, "r:", "user_id", "recording_msid"),
    "canonical_counts_f2_delta": CANON_F2,
    "canonical_changes_f1": f"""
        with j as (select l.user_id, l.recording_msid, l."timestamp" as ts, t.recording_mbid
                     from ({F1_LOG}) l join ({F1_TRACKS}) t using (recording_msid) where t.recording_mbid is not null),
             now as (select distinct recording_mbid, first_value(recording_msid) over (
                       partition by recording_mbid order by ts, recording_msid) as new_item from j),
             old as (select distinct recording_mbid, first_value(recording_msid) over (
                       partition by recording_mbid order by ts, recording_msid) as old_item from j where hour(ts) % 2 = 0),
             c as (select recording_mbid, user_id, count(distinct ts) as listens from j group by 1, 2)
        select recording_mbid, old_item, new_item, user_id, listens
          from now join old using (recording_mbid) join c using (recording_mbid) where old_item <> new_item""",
    "laid_out_top": f"""
        select user_id, recording_msid, listens, cast(rn as integer) as pos from (
          select *, row_number() over (partition by user_id order by listens desc, recording_msid) as rn
            from ({counts_of(F2_LOG)})) where rn <= 10""",
    "csv_round_trip": counts_of(F2_LOG),
    "tuning_folds_f1": f"""
        select *, cast(floor({H('f:', 'user_id', 'recording_msid')} * 5) as integer) as fold from ({counts_of(F1_LOG)})""",
}
for _name in ("mips_exact", "mips_exact_ties"):
    ORACLE[_name.replace("exact", "bounded")] = ORACLE[_name]
