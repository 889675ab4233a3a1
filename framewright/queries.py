"""Registered queries: each operator applied to whole tables, with the DuckDB SQL that gives the same rows.

The tables play episodic roles: events are scalar trajectories of users in order of time; embeddings are pose and joint
vectors of the episode ``label``; lineitem is episodes of orders; conversations are episodes of turns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .functions import signals, so3, text
from .operators import kinematics, meta, resample, stats, trajectory
from .operators.trajectory import Frames
from .plans import packing, registry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def rd(x: Column, digits: int = 6) -> Column:
    return F.round(x, digits) + F.lit(0.0)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


EVENTS = Frames("user_id", ["ts", "event_id"])
POSES = Frames("label", "vec_id")
LINES = Frames("l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"])
_W = "partition by user_id order by ts, event_id"
_P = "partition by label order by vec_id"


def events(spark, d):
    return table(spark, d, "events")


def poses(spark, d):
    """embeddings as poses: xyz, rpy, quat (4), rot6d (6), joints (6) in double."""
    e = table(spark, d, "embeddings")
    v = F.transform("embedding", lambda x: x.cast("double"))
    return e.select("vec_id", "label", F.slice(v, 1, 3).alias("xyz"), F.slice(v, 4, 3).alias("rpy"), F.slice(v, 7, 4).alias("quat"), F.slice(v, 11, 6).alias("rot6d"), F.slice(v, 17, 6).alias("q"))


_POSES = "select vec_id, label, " + ", ".join(f"cast(embedding[{k}] as double) as e{k}" for k in range(1, 23)) + " from embeddings"


# --- frames, windows -----------------------------------------------------------------------------
@query(f"select user_id, event_id, row_number() over ({_W}) - 1 as frame_index, (row_number() over ({_W}) - 1) / 10.0::double as timestamp from events")
def episode_index_frames(spark, d):
    return trajectory.with_timestamp(trajectory.with_frame_index(events(spark, d), EVENTS), 10).select("user_id", "event_id", "frame_index", "timestamp")


@query(f"select user_id, event_id, round(coalesce(lead(value) over ({_W}) - value, 0), 6) + 0.0 as delta from events")
def forward_delta(spark, d):
    return events(spark, d).select("user_id", "event_id", rd(trajectory.forward_delta(F.col("value"), EVENTS)).alias("delta"))


@query(f"""with p as ({_POSES}), n as (select *, {', '.join(f'lead(e{k}) over ({_P}) as n{k}' for k in range(1, 7))} from p)
select vec_id, {', '.join(f'round(n{k} - e{k}, 6) + 0.0 as a{k}' for k in range(1, 7))}, round(e22, 6) + 0.0 as a7 from n where n1 is not null""")
def relabel_actions_drop_last(spark, d):
    p = poses(spark, d).withColumn("state", F.concat("xyz", "rpy"))
    out = trajectory.relabel_actions(p, POSES, "state", "q")
    return out.select("vec_id", *[rd(F.get("action", F.lit(k))).alias(f"a{k + 1}") for k in range(7)])


@query(f"select user_id, event_id, row_number() over ({_W}) - 2 as frame_index from events qualify row_number() over ({_W}) > 1")
def drop_first_reindex(spark, d):
    return trajectory.drop_first(events(spark, d), EVENTS).select("user_id", "event_id", "frame_index")


@query(f"""with s as (select *, value / (max(value) over ()) as g from events),
t as (select *, case when g > 0.95 then 1.0 when g < 0.05 then 0.0 end as st from s)
select user_id, event_id, round(coalesce(first_value(st ignore nulls) over ({_W} rows between current row and unbounded following), last_value(g) over ({_W} rows between unbounded preceding and unbounded following)), 6) + 0.0 as gripper from t""")
def gripper_binarize(spark, d):
    e = events(spark, d)
    e = e.join(F.broadcast(e.agg(F.max("value").alias("top")))).withColumn("g", F.col("value") / F.col("top"))
    return e.select("user_id", "event_id", rd(trajectory.binarize_gripper(F.col("g"), EVENTS)).alias("gripper"))


_REL = "case when delta < -0.1 then 1.0 when delta > 0.1 then -1.0 end"


@query(f"""with x as (select *, coalesce(lead(value) over ({_W}) - value, 0) / 100 as delta from events), t as (select *, {_REL} as mv from x)
select user_id, event_id, coalesce(last_value(mv ignore nulls) over ({_W} rows between unbounded preceding and current row), -first_value(mv ignore nulls) over ({_W} rows between unbounded preceding and unbounded following), 1.0) / 2 + 0.5 as gripper from t""")
def gripper_rel2abs(spark, d):
    e = events(spark, d).withColumn("delta", trajectory.forward_delta(F.col("value"), EVENTS) / 100)
    return e.select("user_id", "event_id", trajectory.relative_to_absolute_gripper(F.col("delta"), EVENTS).alias("gripper"))


_NOOP = f"""with t as (select *, value < 20 as rests from events),
u as (select *, max(case when not rests then 1 else 0 end) over ({_W} rows between unbounded preceding and 1 preceding) as moved, lag(event_type) over ({_W}) as before from t),
v as (select user_id, event_id, rests and (coalesce(moved, 0) = 0 or event_type = before) as noop from u)"""


def _noops(spark, d):
    return events(spark, d).withColumn("noop", trajectory.is_noop(F.col("value"), F.col("event_type"), EVENTS, 20.0)).select("user_id", "event_id", "noop")


@query(_NOOP + " select * from v")
def noop_audit(spark, d):
    return _noops(spark, d)


@query(_NOOP + """, p as (select user_id, count(*) as f, sum(noop::int) as c from v group by 1)
select count(*) as episodes, sum(f)::bigint as frames, sum(c)::bigint as candidates, round(sum(c) / sum(f), 9) as share, sum((f = c)::int)::bigint as all_noop from p""")
def noop_rollup(spark, d):
    return stats.noop_rollup(_noops(spark, d), "user_id", "noop").withColumn("share", F.round("share", 9))


@query("""with r as (select user_id, lag(user_id) over (order by ts, event_id) as before from events)
select user_id, count(*) as runs from r where before is distinct from user_id group by 1""")
def episode_runs(spark, d):
    return trajectory.episode_runs(events(spark, d), "user_id", ["ts", "event_id"])


@query("""with e as (select user_id as episode_index, count(*) as length from events group by 1)
select *, sum(length) over (order by episode_index)::bigint as dataset_to_index, (sum(length) over (order by episode_index) - length)::bigint as dataset_from_index from e""")
def dataset_offsets(spark, d):
    e = events(spark, d).groupBy(F.col("user_id").alias("episode_index")).agg(F.count("*").alias("length"))
    return trajectory.dataset_offsets(e)


@query(f"""with f as (select user_id, event_id, row_number() over ({_W}) - 1 as frame_index from events), e as (select user_id, count(*) as n from events group by 1),
o as (select user_id, sum(n) over (order by user_id) - n as off from e)
select user_id as episode_index, frame_index, (off + frame_index)::bigint as index from f join o using (user_id)""")
def global_frame_index(spark, d):
    f = trajectory.with_frame_index(events(spark, d), EVENTS).select(F.col("user_id").alias("episode_index"), "frame_index")
    e = f.groupBy("episode_index").agg(F.count("*").alias("length"))
    return trajectory.global_index(f, e)


@query("""select conv_id, turn, row_number() over (partition by conv_id order by turn) = 1 as is_first,
lead(1) over (partition by conv_id order by turn) is null as is_last, lead(1) over (partition by conv_id order by turn) is null as is_terminal from conversations""")
def step_flags(spark, d):
    return trajectory.step_flags(table(spark, d, "conversations"), Frames("conv_id", "turn")).select("conv_id", "turn", "is_first", "is_last", "is_terminal")


@query("""with c as (select o_orderkey, o_custkey % 7 as shard, row_number() over (partition by o_custkey % 7 order by o_orderkey) - 1 as episode_index from orders),
s as (select shard, count(*) as n from c group by 1), o as (select shard, sum(n) over (order by shard) - n as off from s)
select o_orderkey, (episode_index + off)::bigint as episode_index from c join o using (shard)""")
def shard_reoffset(spark, d):
    o = table(spark, d, "orders").withColumn("shard", F.col("o_custkey") % 7)
    o = o.withColumn("episode_index", (F.row_number().over(W.partitionBy("shard").orderBy("o_orderkey")) - 1).cast("long"))
    shards = o.groupBy("shard").agg(F.count("*").alias("total_episodes"))
    return trajectory.shard_reoffset(o, shards).select("o_orderkey", "episode_index")


@query(f"""with p as ({_POSES}), m as (select *, sqrt((lead(e1) over ({_P}) - e1)^2 + (lead(e2) over ({_P}) - e2)^2 + (lead(e3) over ({_P}) - e3)^2) as far from p),
n as (select *, coalesce(far > 2.0, false) or coalesce(lag(far) over ({_P}) > 2.0, false) as moving, abs(e4) as residual from m)
select label, sum(moving::int)::bigint as moving, round(coalesce(avg(case when moving then residual end), avg(residual)), 6) as residual from n group by 1""")
def moving_mask_residual(spark, d):
    p = poses(spark, d).withColumns({"moving": trajectory.moving_mask(F.col("xyz"), POSES, 2.0), "residual": F.abs(F.get("rpy", F.lit(0)))})
    return p.groupBy("label").agg(F.sum(F.col("moving").cast("long")).alias("moving"), F.round(trajectory.mean_where_any(F.col("residual"), F.col("moving")), 6).alias("residual"))


@query("""with t as (select event_type as task, min((ts, event_id)) as o from events group by 1)
select task, row_number() over (order by o, task) - 1 as task_index from t""")
def task_dictionary(spark, d):
    return meta.task_dictionary(events(spark, d).withColumnRenamed("event_type", "task"), "task", ["ts", "event_id"])


@query("""with f as (select user_id, event_type, min(ts) as o from events group by 1, 2)
select user_id, string_agg(event_type, '|' order by o, event_type) as tasks from f group by 1""")
def tasks_by_episode(spark, d):
    return stats.tasks_by_episode(events(spark, d), "user_id", "event_type", "ts").select("user_id", F.array_join("tasks", "|").alias("tasks"))


# --- statistics ----------------------------------------------------------------------------------
_Q = "quantile_cont(value, {q})"
_STATS = "round(min(value), 6) as min, round(max(value), 6) as max, round(avg(value), 6) as mean, round(stddev_pop(value), 6) as std, count(value) as count, " + ", ".join(f"round(quantile_cont(value, {q}), 6) as q{int(100 * q):02d}" for q in (0.01, 0.1, 0.5, 0.9, 0.99))
_ROUNDED = ["min", "max", "mean", "std", "q01", "q10", "q50", "q90", "q99"]


@query(f"select user_id, {_STATS} from events group by 1")
def episode_stats(spark, d):
    s = stats.feature_stats(events(spark, d), ["user_id"], "value")
    return s.withColumns({c: F.round(c, 6) for c in _ROUNDED})


@query(f"with d as (select user_id, coalesce(lead(value) over ({_W}) - value, 0) as value from events) select user_id, {_STATS} from d group by 1")
def delta_stats(spark, d):
    """Scan, window, aggregate: statistics of the forward differences of each trajectory."""
    e = events(spark, d).select("user_id", trajectory.forward_delta(F.col("value"), EVENTS).alias("value"))
    return stats.feature_stats(e, ["user_id"], "value").withColumns({c: F.round(c, 6) for c in _ROUNDED})


@query(f"select {_STATS} from events")
def global_stats(spark, d):
    s = stats.global_stats(events(spark, d), [], "value")
    return s.withColumns({c: F.round(c, 6) for c in _ROUNDED})


@query(f"""with u as (select label, unnest(embedding)::double as value, generate_subscripts(embedding, 1) - 1 as dim from embeddings) select label, dim::int as dim, {_STATS} from u group by all""")
def vector_stats(spark, d):
    s = stats.vector_stats(table(spark, d, "embeddings"), ["label"], "embedding")
    return s.withColumns({c: F.round(c, 6) for c in _ROUNDED})


@query("select event_type, round(min(value), 6) as min, round(max(value), 6) as max, round(avg(value), 6) as mean, round(stddev_pop(value), 6) as std, count(*)::bigint as count from events group by 1")
def merged_stats(spark, d):
    parts = stats.feature_stats(events(spark, d), ["event_type", "user_id"], "value", ())
    return stats.merge_stats(parts, ["event_type"]).withColumns({c: F.round(c, 6) for c in ["min", "max", "mean", "std"]})


@query("""select l_returnflag, 0.01::double as q, round(quantile_cont(l_quantity, 0.01), 6) as value from lineitem group by 1
union all select l_returnflag, 0.5::double, round(quantile_cont(l_quantity, 0.5), 6) from lineitem group by 1
union all select l_returnflag, 0.99::double, round(quantile_cont(l_quantity, 0.99), 6) from lineitem group by 1""")
def histogram_quantiles(spark, d):
    h = stats.value_histogram(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity")
    return stats.histogram_quantiles(h, ["l_returnflag"]).withColumn("value", F.round("value", 6))


@query("select l_returnflag, l_quantity as value, count(*) as n from lineitem group by 1, 2")
def channel_histogram(spark, d):
    return stats.value_histogram(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity")


@query("""with a as (select event_type, min(value) as mn, max(value) as mx, avg(value) as av, stddev_pop(value) as sd from events group by 1),
b as (select event_type, min(value) as mn, max(value) as mx, avg(value) as av, stddev_pop(value) as sd from events where event_id % 2 = 0 group by 1)
select event_type, true as in_left, true as in_right, abs(a.mn - b.mn) <= 0.05 + 0.01 * abs(b.mn) as min_ok, abs(a.mx - b.mx) <= 0.05 + 0.01 * abs(b.mx) as max_ok, abs(a.av - b.av) <= 0.05 + 0.01 * abs(b.av) as mean_ok, abs(a.sd - b.sd) <= 0.05 + 0.01 * abs(b.sd) as std_ok from a join b using (event_type)""")
def stats_consistency(spark, d):
    e = events(spark, d)
    whole, half = (stats.feature_stats(x, ["event_type"], "value", ()) for x in (e, e.where("event_id % 2 = 0")))
    return stats.compare_stats(whole, half, ["event_type"], rtol=0.01, atol=0.05)


@query("select count(*) as n, min(user_id) as least, max(user_id) as greatest, (min(user_id) = 0 and max(user_id) = count(*) - 1 and count(distinct user_id) = count(*)) as contiguous from (select distinct user_id from events)")
def contiguity(spark, d):
    return stats.contiguity(events(spark, d).select("user_id").distinct(), "user_id")


@query("""with e as (select user_id, count(*) as length from events group by 1)
select count(*) as total_episodes, sum(length)::bigint as total_frames, (select count(distinct event_type) from events) as total_tasks, 3 * count(*) as total_videos, ceil(count(*) / 1000.0)::bigint as total_chunks from e""")
def dataset_totals(spark, d):
    e = events(spark, d)
    return stats.totals(e.groupBy("user_id").agg(F.count("*").alias("length")), e.select("event_type").distinct(), cameras=3)


@query("select l_shipmode_proxy, round(avg(err), 6) as mean, round(quantile_cont(err, 0.95), 6) as p95, round(max(err), 6) as worst from (select l_returnflag as l_shipmode_proxy, abs(l_discount - l_tax) as err from lineitem) group by 1")
def error_summary(spark, d):
    e = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("l_shipmode_proxy"), F.abs(F.col("l_discount") - F.col("l_tax")).alias("err"))
    return stats.error_summary(e, ["l_shipmode_proxy"], "err").withColumns({c: F.round(c, 6) for c in ("mean", "p95", "worst")})


@query("select l_orderkey, l_partkey, l_extendedprice from lineitem qualify row_number() over (partition by l_orderkey order by l_extendedprice, l_partkey) = 1")
def best_candidate(spark, d):
    return stats.best_candidate(table(spark, d, "lineitem"), ["l_orderkey"], "l_partkey", "l_extendedprice")


@query("select event_type, round(regr_slope(value, user_id), 6) as slope, round(regr_intercept(value, user_id), 6) as intercept, round(regr_r2(value, user_id), 6) as r2 from events group by 1")
def linear_fit(spark, d):
    f = stats.linear_fit(events(spark, d), ["event_type"], "user_id", "value")
    return f.withColumns({c: F.round(c, 6) for c in ("slope", "intercept", "r2")})


# --- joins, sets, quality ------------------------------------------------------------------------
@query("select s_suppkey, s_name, coalesce(n_name, 'nowhere') as n_name from supplier left join (select * from nation where n_nationkey % 2 = 0) on s_nationkey = n_nationkey")
def provenance_left_join(spark, d):
    n = table(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    s = table(spark, d, "supplier").withColumn("s_nationkey", F.col("s_nationkey").cast(n.schema["s_nationkey"].dataType))
    return meta.left_lookup(s, n, ["s_nationkey"], {"n_name": "nowhere"}).select("s_suppkey", "s_name", "n_name")


@query("select c_custkey, n_name from customer join nation on c_nationkey = n_nationkey")
def strict_lookup(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return meta.strict_lookup(table(spark, d, "customer"), n, ["c_nationkey"]).select("c_custkey", "n_name")


@query("select doc_id, quality, toxic from documents left join labels using (doc_id)")
def sidecar_labels(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left").select("doc_id", "quality", "toxic")


@query("select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def subset_mask(spark, d):
    mask = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return meta.subset(table(spark, d, "orders"), mask, ["o_custkey"]).select("o_orderkey")


@query("select o_orderkey from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_linenumber >= 4 and l.l_quantity > 25)")
def pending_downloads(spark, d):
    ledger = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    done = (F.col("l.l_linenumber") >= 4) & (F.col("l.l_quantity") > 25)
    return meta.pending(table(spark, d, "orders").select("o_orderkey"), ledger, ["o_orderkey"], done)


@query("select p_partkey from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 49)")
def orphan_prune(spark, d):
    used = table(spark, d, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return meta.orphans(table(spark, d, "part").select("p_partkey"), used, ["p_partkey"])


@query("""with a as (select user_id, count(*) as n from events group by 1), b as (select user_id, round(avg(value), 6) as mean from events group by 1), c as (select user_id, min(event_id) as first_event from events group by 1), e as (select user_id, max(event_id) as last_event from events group by 1)
select * from a join b using (user_id) join c using (user_id) join e using (user_id)""")
def four_way_merge(spark, d):
    g = events(spark, d).groupBy("user_id")
    parts = [g.agg(F.count("*").alias("n")), g.agg(F.round(F.avg("value"), 6).alias("mean")), g.agg(F.min("event_id").alias("first_event")), g.agg(F.max("event_id").alias("last_event"))]
    return meta.keyed_merge(parts, "user_id")


@query("""with s as (select user_id as ep, min(event_id) as lo, min(event_id) + 40 as hi from events group by 1)
select event_id, ep from events join s on event_id >= lo and event_id < hi""")
def unpack_range(spark, d):
    e = events(spark, d)
    spans = e.groupBy(F.col("user_id").alias("ep")).agg(F.min("event_id").alias("lo")).withColumn("hi", F.col("lo") + 40)
    return meta.in_ranges(e.select("event_id"), spans, "event_id", "lo", "hi", 64).select("event_id", "ep")


@query("""select n_name, exists (select 1 from supplier where s_nationkey = n_nationkey) as present from nation""")
def camera_presence(spark, d):
    n = table(spark, d, "nation").withColumn("k", F.col("n_nationkey").cast("long"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").cast("long").alias("k"))
    return meta.wanted_with_presence(n, s, ["k"]).select("n_name", "present")


@query("select event_id, value from events where user_id in (select user_id from events group by 1 having count(*) >= 60)")
def min_length_filter(spark, d):
    return meta.min_length(events(spark, d), "user_id", 60).select("event_id", "value")


@query("select event_id from events where user_id not in (select user_id from events group by 1 having max(value) > 150)")
def qc_drop_episode(spark, d):
    return meta.drop_by_threshold(events(spark, d), "user_id", F.col("value"), 150.0).select("event_id")


@query("""with o as (select * from orders where o_orderdate < '1996-01-01'), runs as (select distinct o_orderpriority as x from orders where x not in (select o_orderpriority from o)),
r as (select count(*) as c from orders where o_orderkey not in (select o_orderkey from o)), u as (select distinct o_custkey from orders where o_custkey not in (select o_custkey from o))
select (select count(*) from runs) as new_runs, (select c from r) as new_rollouts, (select count(*) from u) as new_users, (select coalesce(string_agg(o_custkey::varchar, ',' order by o_custkey), '') from u) as users""")
def snapshot_diff(spark, d):
    new = table(spark, d, "orders")
    old = new.where("o_orderdate < timestamp_ntz'1996-01-01 00:00:00'")
    return meta.snapshot_diff(old, new, "o_orderpriority", "o_orderkey", "o_custkey").withColumn("users", F.array_join(F.transform("users", lambda x: x.cast("string")), ","))


@query("""(select 'left' as side, k from (select distinct s_nationkey::bigint as k from supplier except select distinct c_nationkey::bigint from customer where c_custkey % 50 = 0))
union all (select 'right', k from (select distinct c_nationkey::bigint as k from customer where c_custkey % 50 = 0 except select distinct s_nationkey::bigint from supplier))""")
def set_differences(spark, d):
    a = table(spark, d, "supplier").select(F.col("s_nationkey").cast("long").alias("k"))
    b = table(spark, d, "customer").where("c_custkey % 50 = 0").select(F.col("c_nationkey").cast("long").alias("k"))
    return meta.set_differences(a, b, ["k"])


@query("""with e as (select distinct c_custkey as k from customer), a as (select distinct o_custkey as k from orders)
select (select count(*) from e) as expected, (select count(*) from e join a using (k)) as found, (select count(*) from e where k not in (select k from a)) as missing, (select count(*) from a where k not in (select k from e)) as extra,
(select count(*) from e where k not in (select k from a)) = 0 and (select count(*) from a where k not in (select k from e)) = 0 as complete""")
def coverage_gate(spark, d):
    return meta.coverage_gate(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select(F.col("o_custkey").alias("k")), ["k"])


@query("""with r as (select p_partkey, row_number() over (order by p_partkey) - 1 as o, count(*) over () as n from part)
select p_partkey, (case when o < (n % 7) * (n // 7 + 1) then o // (n // 7 + 1) else n % 7 + (o - (n % 7) * (n // 7 + 1)) // (n // 7) end)::bigint as array_split, (((o + 1) * 7 - 1) // n)::bigint as linspace, o >= (20 * n + 50) // 100 and o < (60 * n + 50) // 100 as slice, o % (n // 10) = 0 and o // (n // 10) < 10 as strided from r""")
def sharding_rules(spark, d):
    p = trajectory.global_rank(table(spark, d, "part").select("p_partkey"), ["p_partkey"], "o")
    n = p.count()
    return p.select("p_partkey", meta.array_split_shard(F.col("o"), n, 7).alias("array_split"), meta.linspace_shard(F.col("o"), n, 7).alias("linspace"), meta.percent_slice(F.col("o"), n, 20, 60).alias("slice"), meta.strided_sample(F.col("o"), n, 10).alias("strided"))


@query("""with n as (select count(*) as n from part), i as (select distinct round_even(k * ((n - 1) / 15.0::double), 0)::bigint as "at" from n, range(16) t(k)) select "at" from i""")
def even_sample(spark, d):
    n = table(spark, d, "part").count()
    return spark.range(1).select(F.explode(meta.even_indices(n, 16)).alias("at"))


@query("""with s as (select event_type, max(user_id) + 1 as n from events group by 1), o as (select event_type, coalesce(sum(n) over (order by event_type rows between unbounded preceding and 1 preceding), 0) as before from s)
select (user_id + before)::bigint as episode_index, event_id from events join o using (event_type)""")
def union_shards(spark, d):
    e = events(spark, d).select(F.col("user_id").alias("episode_index"), "event_id", "event_type")
    kinds = sorted(r[0] for r in e.select("event_type").distinct().collect())  # as many as there are shards
    return meta.union_shards([e.where(F.col("event_type") == t).drop("event_type") for t in kinds])


# --- resampling ----------------------------------------------------------------------------------
def _series(spark, d):
    e = events(spark, d)
    t = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    s = e.where("event_id % 3 <> 0").select("user_id", t.alias("t"), "event_id", "value").groupBy("user_id", "t").agg(F.max_by("value", "event_id").alias("value"))
    q = e.where("event_id % 3 = 0").select("user_id", t.alias("t"), "event_id")
    return s, q


_SERIES = """with s as (select user_id, epoch_us(ts) / 1e6 as t, max_by(value, event_id) as value from events where event_id % 3 <> 0 group by 1, 2),
q as (select user_id, epoch_us(ts) / 1e6 as t, event_id from events where event_id % 3 = 0),
p as (select q.*, s.t as pt, s.value as pv from q asof left join s on q.user_id = s.user_id and q.t >= s.t),
b as (select p.*, s.t as nt, s.value as nv from p asof left join s on p.user_id = s.user_id and p.t <= s.t)"""


def _nearest_sql(op: str) -> str:
    left = f"nt is null or (pt is not null and t - pt {op} nt - t)"
    return _SERIES + f" select user_id, event_id, round(case when {left} then pv else nv end, 6) as value from b where pt is not null or nt is not null"


@query(_nearest_sql("<="))
def nearest_resample_earlier(spark, d):
    s, q = _series(spark, d)
    return resample.nearest(s, q, ["user_id"], "t", ["value"]).where("value is not null").select("user_id", "event_id", F.round("value", 6).alias("value"))


@query(_nearest_sql("<"))
def nearest_resample_later(spark, d):
    s, q = _series(spark, d)
    return resample.nearest(s, q, ["user_id"], "t", ["value"], "later").where("value is not null").select("user_id", "event_id", F.round("value", 6).alias("value"))


@query(_SERIES + " select user_id, event_id, round(case when pt is null then nv when nt is null then pv when nt = pt then pv else pv + (nv - pv) * ((t - pt) / (nt - pt)) end, 4) as value from b where pt is not null or nt is not null")
def linear_resample(spark, d):
    s, q = _series(spark, d)
    return resample.linear(s, q, ["user_id"], "t", ["value"]).where("value is not null").select("user_id", "event_id", F.round("value", 4).alias("value"))


@query("""with s as (select user_id, min(value) as a, max(value) as b from events group by 1), n as (select *, greatest(1, round_even((b - a) * 0.5::double, 0)::int + 1) as n from s)
select user_id, k::int as step, round(a + k / 0.5::double, 6) as t from n, lateral (select unnest(range(n)) as k)""")
def uniform_grid(spark, d):
    s = events(spark, d).groupBy("user_id").agg(F.min("value").alias("a"), F.max("value").alias("b"))
    return resample.uniform_grid(s, ["user_id"], "a", "b", 0.5).withColumn("t", F.round("t", 6))


def _filter_sql(b, a, order: int, pad: int) -> str:
    """Forward and backward recurrences as recursive queries, with odd extension at the ends."""
    z = resample._steady(b, a)
    num = lambda v: f"({float(v)!r}::double)"
    names = [f"s{k}" for k in range(order)]

    def sweep(name: str, source: str) -> str:
        first = f"select user_id, j, {num(b[0])} * x + {num(z[0])} * x as y, " + ", ".join((f"{num(z[k + 1])} * x + " if k + 1 < order else "") + f"{num(b[k + 1])} * x - {num(a[k + 1])} * ({num(b[0])} * x + {num(z[0])} * x) as {names[k]}" for k in range(order)) + f" from {source} where j = 1"
        step = f"select e.user_id, e.j, {num(b[0])} * e.x + p.s0 as y, " + ", ".join((f"p.{names[k + 1]} + " if k + 1 < order else "") + f"{num(b[k + 1])} * e.x - {num(a[k + 1])} * ({num(b[0])} * e.x + p.s0)" for k in range(order)) + f" from {name} p join {source} e on e.user_id = p.user_id and e.j = p.j + 1"
        return f"{name} as ({first} union all {step})"

    return f"""with recursive e as (select user_id, event_id, value, row_number() over ({_W}) as i, count(*) over (partition by user_id) as n from events),
ext as (
  select user_id, i + {pad} as j, n + {2 * pad} as m, value as x from e where n > {pad}
  union all select a.user_id, {pad} + 2 - e.i, e.n + {2 * pad}, 2 * a.value - e.value from e join e a on a.user_id = e.user_id and a.i = 1 where e.n > {pad} and e.i between 2 and {pad + 1}
  union all select a.user_id, 2 * e.n - e.i + {pad}, e.n + {2 * pad}, 2 * a.value - e.value from e join e a on a.user_id = e.user_id and a.i = a.n where e.n > {pad} and e.n - e.i between 1 and {pad}),
{sweep("fwd", "ext")},
turned as (select f.user_id, x.m + 1 - f.j as j, f.y as x, x.m from fwd f join ext x on x.user_id = f.user_id and x.j = f.j),
{sweep("bwd", "turned")}
select e.user_id, e.event_id, round(coalesce(b.y, e.value), 6) as value from e left join bwd b on b.user_id = e.user_id and b.j = e.n + {pad} + 1 - e.i"""


@query(_filter_sql(*resample.butterworth(2, 5.0 / 15.0), 2, 9))
def butterworth_smooth(spark, d):
    e = events(spark, d).select("user_id", "ts", "event_id", "value")
    return resample.smooth(e, ["user_id"], ["ts", "event_id"], ["value"], 30.0, 5.0).select("user_id", "event_id", F.round("value", 6).alias("value"))


@query("""with st as (select l_orderkey as ep, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 as frame, l_quantity as v from lineitem),
sz as (select ep, count(*) as n, sum((frame % 2)::int) as m from st group by 1)
select ep, frame, case when ep % 5 = 0 or (ep % 5 > 1 and n = 1) then 0.0 when ep % 5 <> 1 and frame % 2 = 1 then -v else v end as v from st join sz using (ep)""")
def length_repair(spark, d):
    by = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    st = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ep"), (F.row_number().over(by) - 1).cast("long").alias("frame"), F.col("l_quantity").alias("v"))
    # Every fifth order has no actions, every fifth the state's own, the others actions at odd frames.
    act = st.where("ep % 5 = 1 or (ep % 5 > 1 and frame % 2 = 1)").select("ep", "frame", F.when(F.col("ep") % 5 == 1, F.col("v")).otherwise(-F.col("v")).alias("v"))
    act = act.withColumn("position", (F.row_number().over(W.partitionBy("ep").orderBy("frame")) - 1).cast("long"))
    return resample.repair_lengths(st, act.select("ep", "position", "v"), act.select("ep", "position", "frame"), "ep", "frame", "v", F.lit(0.0))


# --- packing, layout -----------------------------------------------------------------------------
def _packing_sql(table_sql: str, limit: float) -> str:
    return f"""with recursive e as (select *, row_number() over (partition by g order by k) as r from ({table_sql})),
f as (select g, k, r, s, s as acc, 0::bigint as file from e where r = 1
union all select e.g, e.k, e.r, e.s, case when f.acc + e.s >= {limit} then e.s else f.acc + e.s end, f.file + case when f.acc + e.s >= {limit} then 1 else 0 end from f join e on e.g = f.g and e.r = f.r + 1)
select g, k, file as ordinal, file // 1000 as chunk_index, file % 1000 as file_index from f"""


@query(_packing_sql("select o_orderpriority as g, o_orderkey as k, o_totalprice as s from orders", 1000000))
def data_packing(spark, d):
    e = table(spark, d, "orders").select(F.col("o_orderpriority").alias("g"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("s"))
    return packing.pack(e, ["g"], "k", "s", 1000000).select("g", "k", "ordinal", "chunk_index", "file_index")


@query(f"""with p as ({_packing_sql("select c_mktsegment as g, c_custkey as k, abs(c_acctbal) as s from customer", 20000)}), j as (select p.*, abs(c_acctbal) as s from p join customer on c_custkey = k)
select g, k, ordinal, round(sum(s) over (partition by g, ordinal order by k) - s, 4) + 0.0 as from_timestamp, round(sum(s) over (partition by g, ordinal order by k), 4) + 0.0 as to_timestamp from j""")
def video_packing(spark, d):
    e = table(spark, d, "customer").select(F.col("c_mktsegment").alias("g"), F.col("c_custkey").alias("k"), F.abs("c_acctbal").alias("s"))
    p = trajectory.video_offsets(packing.pack(e, ["g"], "k", "s", 20000), ["g", "ordinal"], "k", "s")
    return p.select("g", "k", "ordinal", rd(F.col("from_timestamp"), 4).alias("from_timestamp"), rd(F.col("to_timestamp"), 4).alias("to_timestamp"))


@query("""select o_orderkey, printf('data/chunk-%03d/file-%03d.parquet', o_orderkey // 1000, o_orderkey % 1000) as file, printf('data/chunk-%03d/episode_%06d.parquet', o_orderkey // 1000, o_orderkey) as episode from orders""")
def chunk_paths(spark, d):
    k = F.col("o_orderkey")
    chunk = F.expr("o_orderkey div 1000")
    return table(spark, d, "orders").select("o_orderkey", text.chunk_path("data", chunk, k % 1000).alias("file"), text.episode_path(chunk, k).alias("episode"))


# --- nesting, text -------------------------------------------------------------------------------
@query("select conv_id, count(*)::int as n, string_agg(role, '>' order by turn) as roles from conversations group by 1")
def nest_steps(spark, d):
    n = trajectory.nest(table(spark, d, "conversations"), Frames("conv_id", "turn"), ["role"])
    return n.select("conv_id", F.size("steps").alias("n"), F.array_join(F.transform("steps", lambda s: s["role"]), ">").alias("roles"))


@query("select conv_id, turn, role, row_number() over (partition by conv_id order by turn) - 1 as frame_index from conversations")
def unnest_steps(spark, d):
    n = trajectory.nest(table(spark, d, "conversations"), Frames("conv_id", "turn"), ["role"])
    return trajectory.unnest(n).select("conv_id", "turn", "role", "frame_index")


@query(r"""select page_id, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) as host, coalesce(string_split(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/?([^?#]*)', 1), '/')[1], '') as first_segment,
array_to_string(string_split(url, '/')[-2:], '/') as tail from pages""")
def url_arena(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", text.url_host(u).alias("host"), text.url_segment(u, 1).alias("first_segment"), text.path_tail(u, 2).alias("tail"))


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_prop(spark, d):
    return events(spark, d).select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("select p_partkey, coalesce(nullif(case when p_size > 25 then p_name else '' end, ''), nullif(case when p_size > 10 then p_brand else '' end, ''), p_type) as instruction from part")
def first_nonempty_text(spark, d):
    p = table(spark, d, "part")
    a, b = F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(""), F.when(F.col("p_size") > 10, F.col("p_brand")).otherwise("")
    return p.select("p_partkey", text.first_nonempty(a, b, F.col("p_type")).alias("instruction"))


@query(r"""select p_partkey, translate(regexp_replace('KITCHEN_SCENE3_' || lower(replace(p_type, ' ', '_')) || '_ep' || p_size, '_ep\d+$', ''), '_', ' ') as task, regexp_matches(p_size || '.' || p_partkey || '.0', '^\d+\.\d+\.\d+$') as is_version, regexp_replace('run 03-14-2024 ' || p_size, '(\d{2})-(\d{2})-(\d{4})', '\3_\1_\2') as dated from part""")
def filename_task(spark, d):
    p = table(spark, d, "part")
    name = F.concat(F.lit("KITCHEN_SCENE3_"), F.lower(F.replace("p_type", F.lit(" "), F.lit("_"))), F.lit("_ep"), F.col("p_size").cast("string"))
    return p.select("p_partkey", text.strip_episode(name).alias("task"), text.is_version(F.concat_ws(".", F.col("p_size").cast("string"), F.col("p_partkey").cast("string"), F.lit("0"))).alias("is_version"), text.date_parts(F.concat(F.lit("run 03-14-2024 "), F.col("p_size").cast("string"))).alias("dated"))


# --- vectors -------------------------------------------------------------------------------------
@query("""select vec_id, round(embedding[1]::double, 6) as x0, round(embedding[64]::double, 6) as last, 20 as width, round(least(greatest(embedding[64]::double, 0), 1), 6) + 0.0 as clipped, round(1 - least(greatest(embedding[64]::double, 0), 1), 6) as inverted, round((1 - embedding[64]::double) / 2, 6) + 0.0 as halved from embeddings""")
def vector_encode_pad(spark, d):
    e = table(spark, d, "embeddings").withColumn("v", F.transform("embedding", lambda x: x.cast("double")))
    g = F.element_at("v", -1)
    enc = signals.encode({"xyz": 3, "pad": 10, "tail": 7}, {"xyz": signals.vector_slice(F.col("v"), 0, 3), "tail": signals.vector_slice(F.col("v"), -7)})
    return e.select("vec_id", rd(F.get(enc, F.lit(0))).alias("x0"), rd(F.element_at(enc, -1)).alias("last"), F.size(enc).alias("width"), rd(signals.clip(g)).alias("clipped"), rd(signals.invert_clipped(g)).alias("inverted"), rd(signals.halve_signed(g)).alias("halved"))


@query("select event_id, case when event_type = 'click' then value else 0.0 end as command, case when event_type = 'click' then 1.0::double else 0.0::double end as active from events")
def control_mode_routing(spark, d):
    cmd, active = signals.route(F.col("event_type"), "click", F.array("value"), 1)
    return events(spark, d).select("event_id", F.get(cmd, F.lit(0)).alias("command"), active.cast("double").alias("active"))


# --- rotations -----------------------------------------------------------------------------------
def _matrix(name: str, m: Column) -> list[Column]:
    return [rd(F.get(m, F.lit(k))).alias(f"{name}{k // 3}{k % 3}") for k in range(9)]


def _sql_product(a: list[str], b: list[str]) -> list[str]:
    return [" + ".join(f"({a[3 * i + k]}) * ({b[3 * k + j]})" for k in range(3)) for i in range(3) for j in range(3)]


def _sql_matrix(name: str, m: list[str]) -> str:
    return ", ".join(f"round({x}, 6) + 0.0 as {name}{k // 3}{k % 3}" for k, x in enumerate(m))


_RX, _RY, _RZ = (["1", "0", "0", "0", "cos(e4)", "-sin(e4)", "0", "sin(e4)", "cos(e4)"], ["cos(e5)", "0", "sin(e5)", "0", "1", "0", "-sin(e5)", "0", "cos(e5)"], ["cos(e6)", "-sin(e6)", "0", "sin(e6)", "cos(e6)", "0", "0", "0", "1"])
_INTRINSIC, _EXTRINSIC = _sql_product(_sql_product(_RX, _RY), _RZ), _sql_product(_sql_product(_RZ, _RY), _RX)


@query(f"with p as ({_POSES}) select vec_id, {_sql_matrix('i', _INTRINSIC)}, {_sql_matrix('x', _EXTRINSIC)} from p")
def rot_rpy_to_matrix(spark, d):
    p = poses(spark, d).withColumns({"i": so3.rpy_to_matrix(F.col("rpy")), "x": so3.rpy_to_matrix(F.col("rpy"), True)})
    return p.select("vec_id", *_matrix("i", F.col("i")), *_matrix("x", F.col("x")))


_QUAT = ["1 - s * (j * j + k * k)", "s * (i * j - k * r)", "s * (i * k + j * r)", "s * (i * j + k * r)", "1 - s * (i * i + k * k)", "s * (j * k - i * r)", "s * (i * k - j * r)", "s * (j * k + i * r)", "1 - s * (i * i + j * j)"]


@query(f"with p as ({_POSES}), q as (select vec_id, e7 as i, e8 as j, e9 as k, e10 as r, 2 / (e7 * e7 + e8 * e8 + e9 * e9 + e10 * e10) as s from p) select vec_id, {_sql_matrix('m', _QUAT)} from q")
def quat_to_matrix(spark, d):
    p = poses(spark, d).withColumn("m", so3.quaternion_to_matrix(F.col("quat")))
    return p.select("vec_id", *_matrix("m", F.col("m")))


_AA = ["c + x * x * d", "x * y * d - z * s", "x * z * d + y * s", "y * x * d + z * s", "c + y * y * d", "y * z * d - x * s", "z * x * d - y * s", "z * y * d + x * s", "c + z * z * d"]


@query(f"""with p as ({_POSES}), a as (select vec_id, e4, e5, e6, sqrt(e4 * e4 + e5 * e5 + e6 * e6) as n from p),
b as (select vec_id, e4 / n as x, e5 / n as y, e6 / n as z, sin(n) as s, cos(n) as c, 1 - cos(n) as d from a) select vec_id, {_sql_matrix('m', _AA)} from b""")
def axis_angle_to_matrix(spark, d):
    p = poses(spark, d).withColumn("m", so3.axis_angle_to_matrix(F.col("rpy")))
    return p.select("vec_id", *_matrix("m", F.col("m")))


_SIX = f"""with p as ({_POSES}), a as (select *, sqrt(e11 * e11 + e12 * e12 + e13 * e13) as n from p), b as (select *, e11 / n as ax, e12 / n as ay, e13 / n as az from a),
c as (select *, e14 - (ax * e14 + ay * e15 + az * e16) * ax as ux, e15 - (ax * e14 + ay * e15 + az * e16) * ay as uy, e16 - (ax * e14 + ay * e15 + az * e16) * az as uz from b),
g as (select *, ux / sqrt(ux * ux + uy * uy + uz * uz) as bx, uy / sqrt(ux * ux + uy * uy + uz * uz) as bq, uz / sqrt(ux * ux + uy * uy + uz * uz) as bz from c)"""
_CROSS = ["ay * bz - az * bq", "az * bx - ax * bz", "ax * bq - ay * bx"]


@query(f"{_SIX} select vec_id, {_sql_matrix('c', ['ax', 'bx', _CROSS[0], 'ay', 'bq', _CROSS[1], 'az', 'bz', _CROSS[2]])}, {_sql_matrix('r', ['ax', 'ay', 'az', 'bx', 'bq', 'bz', *_CROSS])} from g")
def rot6d_columns_rows(spark, d):
    p = poses(spark, d).withColumns({"c": so3.rotation_6d_to_matrix(F.col("rot6d")), "r": so3.rot6d_rows_to_matrix(F.col("rot6d"))})
    return p.select("vec_id", *_matrix("c", F.col("c")), *_matrix("r", F.col("r")))


_M = [f"m{k}" for k in range(9)]
_RPY = f"with p as ({_POSES}), m as (select *, {', '.join(f'{x} as m{k}' for k, x in enumerate(_INTRINSIC))} from p)"


@query(_RPY + """, q as (select vec_id, sqrt(greatest(1 + m0 + m4 + m8, 0)) / 2 as w, sqrt(greatest(1 + m0 - m4 - m8, 0)) / 2 * sign(m7 - m5) as x, sqrt(greatest(1 - m0 + m4 - m8, 0)) / 2 * sign(m2 - m6) as y, sqrt(greatest(1 - m0 - m4 + m8, 0)) / 2 * sign(m3 - m1) as z,
atan2(-m5, m8) as a, asin(least(greatest(m2, -1), 1)) as b, atan2(-m1, m0) as c from m), h as (select *, sqrt(x * x + y * y + z * z) as sh from q)
select vec_id, round(x, 5) + 0.0 as x, round(y, 5) + 0.0 as y, round(z, 5) + 0.0 as z, round(w, 5) + 0.0 as w, round(a, 5) + 0.0 as a, round(b, 5) + 0.0 as b, round(c, 5) + 0.0 as c, round(x * 2 * atan2(sh, w) / sh, 5) + 0.0 as vx, round(y * 2 * atan2(sh, w) / sh, 5) + 0.0 as vy, round(z * 2 * atan2(sh, w) / sh, 5) + 0.0 as vz from h""")
def matrix_to_quat_euler_axis_angle(spark, d):
    p = poses(spark, d).withColumn("m", so3.rpy_to_matrix(F.col("rpy")))
    p = p.withColumns({"q": so3.matrix_to_quaternion(F.col("m")), "e": so3.matrix_to_euler(F.col("m"), "XYZ"), "v": so3.matrix_to_axis_angle(F.col("m"))})
    return p.select("vec_id", *[rd(F.get(c, F.lit(k)), 5).alias(n) for c, names in (("q", "xyzw"), ("e", "abc")) for k, n in enumerate(names)], *[rd(F.get("v", F.lit(k)), 5).alias(n) for k, n in enumerate(("vx", "vy", "vz"))])


_FRANKA = [str(v) for row in so3.alignment_rows(*so3.ALIGNMENTS["franka"]) for v in row]
_FRANKA_T = [_FRANKA[3 * j + i] for i in range(3) for j in range(3)]


@query(_RPY + f" select vec_id, {_sql_matrix('r', _sql_product(_M, _FRANKA_T))}, round(e1, 6) + 0.0 as px, round(e2, 6) + 0.0 as py, round(e3, 6) + 0.0 as pz from m")
def align_axis(spark, d):
    p = poses(spark, d).withColumn("m", so3.rpy_to_matrix(F.col("rpy")))
    R, t = so3.align_axis(F.col("m"), F.col("xyz"), so3.axis_alignment_matrix("x", "y", "z"), so3.axis_alignment_matrix(*so3.ALIGNMENTS["franka"]))
    return p.select("vec_id", *_matrix("r", R), *[rd(F.get(t, F.lit(k))).alias(n) for k, n in enumerate(("px", "py", "pz"))])


_NEXT = _RPY + f", n as (select *, {', '.join(f'lead(m{k}) over ({_P}) as n{k}' for k in range(9))}, lead(e1) over ({_P}) as f1, lead(e2) over ({_P}) as f2, lead(e3) over ({_P}) as f3 from m)"
_MT, _N = [f"m{3 * j + i}" for i in range(3) for j in range(3)], [f"n{k}" for k in range(9)]
_NT = [f"m{3 * j + i}" for i in range(3) for j in range(3)]
_GD = _sql_product(_MT, _N)
_SIXOF = (0, 3, 6, 1, 4, 7)


@query(_NEXT + " select vec_id, " + ", ".join(f"round(coalesce({_MT[3 * i]} * (f1 - e1) + {_MT[3 * i + 1]} * (f2 - e2) + {_MT[3 * i + 2]} * (f3 - e3), 0), 5) + 0.0 as p{i}" for i in range(3)) + ", " + ", ".join(f"round(coalesce({_GD[k]}, {float(so3.IDENTITY6[i])}), 5) + 0.0 as r{i}" for i, k in enumerate(_SIXOF)) + " from n")
def gripper_delta(spark, d):
    p = poses(spark, d).withColumn("m", so3.rpy_to_matrix(F.col("rpy")))
    out = trajectory.next_pose_delta(p, POSES, "xyz", "m")
    return out.select("vec_id", *[rd(F.get("gripper_eef_xyz", F.lit(k)), 5).alias(f"p{k}") for k in range(3)], *[rd(F.get("gripper_eef_rot6d", F.lit(k)), 5).alias(f"r{k}") for k in range(6)])


_WD = _sql_product(_N, _NT)


@query(_NEXT + " select vec_id, " + ", ".join(f"round(coalesce(f{i + 1} - e{i + 1}, 0), 5) + 0.0 as w{i}" for i in range(3)) + ", " + ", ".join(f"round(coalesce({_WD[k]}, {float(so3.IDENTITY6[i])}), 5) + 0.0 as r{i}" for i, k in enumerate(_SIXOF)) + " from n")
def world_delta(spark, d):
    p = poses(spark, d).withColumn("m", so3.rpy_to_matrix(F.col("rpy")))
    out = trajectory.relative_motion(p, POSES, "xyz", "rpy", "m")
    return out.select("vec_id", *[rd(F.get("world_xyz", F.lit(k)), 5).alias(f"w{k}") for k in range(3)], *[rd(F.get("world_rot6d", F.lit(k)), 5).alias(f"r{k}") for k in range(6)])


_Q9 = f"with p as ({_POSES}), q0 as (select *, e7 as i, e8 as j, e9 as k, e10 as r, 2 / (e7 * e7 + e8 * e8 + e9 * e9 + e10 * e10) as s from p), m as (select *, {', '.join(f'{x} as s{k}' for k, x in enumerate(_QUAT))}, {', '.join(f'{x} as m{k}' for k, x in enumerate(_INTRINSIC))} from q0)"
_S, _ST = [f"s{k}" for k in range(9)], [f"s{3 * j + i}" for i in range(3) for j in range(3)]
_CONJ = _sql_product([f"({x})" for x in _sql_product(_S, _M)], _ST)


@query(_Q9 + f" select vec_id, {_sql_matrix('r', _CONJ)}, " + ", ".join(f"round(s{3 * i} * e1 + s{3 * i + 1} * e2 + s{3 * i + 2} * e3, 6) + 0.0 as p{i}" for i in range(3)) + " from m")
def change_frame(spark, d):
    p = poses(spark, d).withColumns({"m": so3.rpy_to_matrix(F.col("rpy")), "s": so3.quaternion_to_matrix(F.col("quat"))})
    R, t = so3.change_delta_pose_frame(F.col("m"), F.col("xyz"), F.col("s"))
    return p.select("vec_id", *_matrix("r", R), *[rd(F.get(t, F.lit(k))).alias(f"p{k}") for k in range(3)])


@query(_Q9 + """ select vec_id, true as orthogonal, true as proper, round(degrees(acos(least(greatest((""" + " + ".join(f"m{k} * s{k}" for k in range(9)) + """ - 1) / 2, -1), 1))), 4) + 0.0 as angle from m""")
def rotation_invariants(spark, d):
    p = poses(spark, d).withColumns({"m": so3.rpy_to_matrix(F.col("rpy")), "s": so3.quaternion_to_matrix(F.col("quat"))})
    return p.select("vec_id", (so3.orthogonality_error(F.col("s")) < 2e-5).alias("orthogonal"), (so3.determinant_error(F.col("m")) < 2e-5).alias("proper"), rd(so3.geodesic_degrees(F.col("m"), F.col("s")), 4).alias("angle"))


_PLANAR = kinematics.Chain(tuple(kinematics.Joint(f"j{k}", True, (1, 0, 0, 0, 1, 0, 0, 0, 1), (0.1 * k, 0.0, 0.05), (0.0, 0.0, 1.0)) for k in range(3)), (0.2, 0.0, 0.0))


@query(f"""with p as ({_POSES}) select vec_id, round(0.1 * cos(e17) + 0.2 * cos(e17 + e18) + 0.2 * cos(e17 + e18 + e19), 6) + 0.0 as x, round(0.1 * sin(e17) + 0.2 * sin(e17 + e18) + 0.2 * sin(e17 + e18 + e19), 6) + 0.0 as y, 0.15::double as z from p""")
def fk_serial_chain(spark, d):
    p = kinematics.fk(poses(spark, d).withColumn("j", F.slice("q", 1, 3)), _PLANAR, "j")
    return p.select("vec_id", *[rd(F.get("p", F.lit(k))).alias(n) for k, n in enumerate("xyz")])


# --- dataset rules -------------------------------------------------------------------------------
def _steps(spark, d):
    """embeddings as native steps: observation.state of 8, action of 7."""
    e = table(spark, d, "embeddings").withColumn("v", F.transform("embedding", lambda x: x.cast("double")))
    return e.select("label", "vec_id", F.struct(F.slice("v", 1, 8).alias("state")).alias("observation"), F.slice("v", 9, 7).alias("action"))


@query("""select vec_id, """ + ", ".join(f"round(embedding[{9 + k}]::double, 6) + 0.0 as a{k}" for k in range(6)) + """, round(1 - least(greatest(embedding[15]::double, 0), 1), 6) as a6, 2 as grip_width, round(embedding[1]::double, 6) as e0 from embeddings""")
def rule_libero(spark, d):
    out = registry.standardize(_steps(spark, d), "libero_spatial_no_noops", POSES)
    return out.select("vec_id", *[rd(F.get("action", F.lit(k))).alias(f"a{k}") for k in range(7)], F.size("gripper_state").alias("grip_width"), rd(F.get("eef_state", F.lit(0))).alias("e0"))


_BO = f"with p as ({_POSES}), m as (select *, {', '.join(f'{x} as m{k}' for k, x in enumerate(_EXTRINSIC))} from p)"
_WIDOWX_T = [str(so3.alignment_rows(*so3.ALIGNMENTS["widowx"])[j][i]) for i in range(3) for j in range(3)]


@query(_BO + f""", s as (select *, case when e15 > 0.95 then 1.0 when e15 < 0.05 then 0.0 end as st from m)
select vec_id, {_sql_matrix('r', _sql_product(_M, _WIDOWX_T))}, round(e7, 6) + 0.0 as state_grip, round(coalesce(first_value(st ignore nulls) over ({_P} rows between current row and unbounded following), last_value(e15) over ({_P} rows between unbounded preceding and unbounded following)), 6) + 0.0 as target_grip from s""")
def rule_bridge_orig(spark, d):
    out = registry.standardize(_steps(spark, d), "bridge_orig", POSES)
    return out.select("vec_id", *_matrix("r", F.col("state.eef_rot9d")), rd(F.get("state.gripper_state", F.lit(0))).alias("state_grip"), rd(F.get("target.gripper_state", F.lit(0))).alias("target_grip"))


_KNOWN = sorted(registry.DATASETS)
_VALUES = ", ".join(f"({i}, '{n}', {x.fps}::double, '{x.robot}', {sum(registry.ENCODINGS[x.state].values())}::bigint, {sum(registry.ENCODINGS[x.action].values())}::bigint)" for i, (n, x) in enumerate(sorted(registry.DATASETS.items())))


@query(f"""with v(i, name, fps, robot, state_width, action_width) as (values {_VALUES}), e as (select user_id % {len(_KNOWN) + 1} as i, count(*) as n from events group by user_id)
select coalesce(name, 'unlisted') as name, coalesce(robot, 'unknown') as robot, coalesce(state_width, 0) as state_width, coalesce(action_width, 0) as action_width, count(*) as episodes, round(sum(n / coalesce(fps, 10)), 6) as seconds from e left join v using (i) group by all""")
def dataset_registry(spark, d):
    """Events as episodes of the registered datasets (and of one that isn't): how long they are at their dataset's rate."""
    names = F.array(*[F.lit(n) for n in (*_KNOWN, "unlisted")])
    e = events(spark, d).groupBy("user_id").agg(F.count("*").alias("n")).withColumn("name", F.get(names, (F.col("user_id") % (len(_KNOWN) + 1)).cast("int")))
    out = e.join(registry.table(spark), "name", "left")
    known = [F.coalesce("robot", F.lit(registry.UNKNOWN.robot)).alias("robot"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("state_width", "action_width")]]
    seconds = F.sum(F.col("n") / F.coalesce("fps", F.lit(float(registry.UNKNOWN.fps))))
    return out.groupBy("name", *known).agg(F.count("*").alias("episodes"), F.round(seconds, 6).alias("seconds"))


from . import more_queries  # noqa: E402, F401
