"""Further registered queries: filters, long episodes, kinematic checks, camera and conversion functions, resuming."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import signals, so3
from .operators import kinematics, meta, ranges, stats, trajectory
from .plans import layout, registry
from .queries import _INTRINSIC, _MT, _NEXT, _P, _PLANAR, _POSES, _QUAT, _RPY, ORACLE_SQL, POSES, _matrix, _series, _sql_matrix, _sql_product, events, poses, query, rd, table

_KEY = (["user_id"], ["ts", "event_id"])


# --- episodes of any length ------------------------------------------------------------------------
@query(ORACLE_SQL["forward_delta"])
def long_forward_delta(spark, d):
    return ranges.long_forward_delta(events(spark, d), *_KEY, "value").select("user_id", "event_id", rd(F.col("delta")).alias("delta"))


@query(ORACLE_SQL["gripper_binarize"])
def long_gripper_binarize(spark, d):
    e = events(spark, d)
    e = e.join(F.broadcast(e.agg(F.max("value").alias("top")))).withColumn("g", F.col("value") / F.col("top"))
    return ranges.long_binarize_gripper(e, *_KEY, "g", name="grip").select("user_id", "event_id", rd(F.col("grip")).alias("gripper"))


@query(ORACLE_SQL["gripper_rel2abs"])
def long_gripper_rel2abs(spark, d):
    e = ranges.long_forward_delta(events(spark, d), *_KEY, "value").withColumn("delta", F.col("delta") / 100)
    return ranges.long_absolute_gripper(e, *_KEY, "delta", name="gripper").select("user_id", "event_id", "gripper")


@query(ORACLE_SQL["noop_audit"])
def long_noop_audit(spark, d):
    return ranges.long_noops(events(spark, d), *_KEY, F.col("value"), F.col("event_type"), 20.0).select("user_id", "event_id", "noop")


@query(ORACLE_SQL["nearest_resample_earlier"])
def long_nearest_resample(spark, d):
    s, q = _series(spark, d)
    return ranges.long_nearest(s, q, ["user_id"], "t", ["value"]).where("value is not null").select("user_id", "event_id", F.round("value", 6).alias("value"))


# --- filters ---------------------------------------------------------------------------------------
@query("""with e as (select o_orderkey as episode, o_orderpriority as dataset, o_orderstatus = 'F' as success, count(*) filter (where l_quantity > 25) as length
from orders left join lineitem on l_orderkey = o_orderkey group by all)
select episode, dataset, length from e where length > 0 and (dataset not in ('1-URGENT', '2-HIGH') or success)""")
def nonempty_successes(spark, d):
    lines = table(spark, d, "lineitem").where("l_quantity > 25").groupBy("l_orderkey").agg(F.count("*").alias("length"))
    o = table(spark, d, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    e = o.select(F.col("o_orderkey").alias("episode"), F.col("o_orderpriority").alias("dataset"), (F.col("o_orderstatus") == "F").alias("success"), F.coalesce("length", F.lit(0).cast("long")).alias("length"))
    return meta.keep_episodes(e, F.col("length"), F.col("dataset"), F.col("success"), ["1-URGENT", "2-HIGH"]).select("episode", "dataset", "length")


@query("select user_id, count(*) as n from events group by 1 having count(distinct event_type) filter (where event_type in ('click', 'error', 'purchase')) = 3")
def all_videos_exist(spark, d):
    e = events(spark, d)
    counted = e.groupBy("user_id").agg(F.count("*").alias("n"))
    return meta.with_all_present(counted, e, "user_id", "event_type", ["click", "error", "purchase"])


@query("select c_custkey, c_mktsegment from customer where lower(c_mktsegment) = lower('Machinery') and contains(lower(c_name), lower('CUSTOMER#00'))")
def case_insensitive_filter(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return meta.matching(c, {"c_mktsegment": "Machinery", "c_custkey": None}, {"c_name": "CUSTOMER#00"}).drop("c_name")


_ZERO = "greatest(least(2 * (e{k} - l{k}) / (h{k} - l{k} + 1e-8) - 1, 1), -1)"


@query(f"""with p as ({_POSES}), q as (select {', '.join(f'quantile_cont(e{k}, 0.01) as l{k}, quantile_cont(e{k}, 0.99) as h{k}' for k in (1, 2, 3))} from p)
select vec_id from p, q where not ({' or '.join(f'abs({_ZERO.format(k=k)}) > 0.4' for k in (1, 2, 3))})""")
def zero_action_filter(spark, d):
    p = poses(spark, d)
    per = stats.global_stats(p.select(F.posexplode("xyz").alias("dim", "x")), ["dim"], "x", (0.01, 0.99))
    by_dim = per.agg(F.sort_array(F.collect_list(F.struct("dim", "q01", "q99"))).alias("d"))
    edges = by_dim.select(F.col("d.q01").alias("q01"), F.col("d.q99").alias("q99"))
    return p.join(F.broadcast(edges)).where(signals.is_zero_action(F.col("xyz"), F.col("q01"), F.col("q99"), 0.4)).select("vec_id")


@query("""select event_type, count(*) as n, count(*) filter (where v not in (0.0, 1.0)) as violations from (select event_type, least(greatest(floor(value / 30), 0), 2) as v from events) group by 1""")
def binary_domain(spark, d):
    e = events(spark, d).withColumn("v", F.least(F.greatest(F.floor(F.col("value") / 30), F.lit(0)), F.lit(2)).cast("double"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum((~signals.is_binary(F.col("v"))).cast("long")).alias("violations"))


@query("select event_id, user_id, c_mktsegment as label from events left join customer on c_custkey = user_id")
def label_to_frames(spark, d):
    labels = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("label"))
    return meta.broadcast_label(events(spark, d).select("event_id", "user_id"), labels, "user_id", "label")


@query("""with r as (select p_partkey, row_number() over (order by p_partkey) - 1 as i, count(*) over () as n from part)
select p_partkey, i >= (10 * n + 50) // 100 and i < (30 * n + 50) // 100 as in_slice, i % greatest(n // 7, 1) = 0 and i // greatest(n // 7, 1) < 7 as in_sample, i >= 100 and i < 150 as in_window from r""")
def slices_of_episodes(spark, d):
    ranked = trajectory.global_rank(table(spark, d, "part").select("p_partkey"), ["p_partkey"], "i")
    n = ranked.count()
    i = F.col("i")
    return ranked.select("p_partkey", meta.percent_slice(i, n, 10, 30).alias("in_slice"), meta.strided_sample(i, n, 7).alias("in_sample"), ((i >= 100) & (i < 150)).alias("in_window"))


_SPLITS = {"first": ("train[:25%]", "i < (25 * n + 50) // 100"), "middle": ("train[25%:75%]", "i >= (25 * n + 50) // 100 and i < (75 * n + 50) // 100"), "tail": ("train[-100:]", "i >= n - 100"), "ends": ("train[:10] + train[-10:]", "i < 10 or i >= n - 10")}


@query(f"""with r as (select c_custkey, row_number() over (order by c_custkey) - 1 as i, count(*) over () as n from customer) select c_custkey, {', '.join(f'({sql}) as {name}' for name, (_, sql) in _SPLITS.items())} from r""")
def split_strings(spark, d):
    ranked = trajectory.global_rank(table(spark, d, "customer").select("c_custkey"), ["c_custkey"], "i")
    n = ranked.count()
    return ranked.select("c_custkey", *[meta.in_split(F.col("i"), n, split).alias(name) for name, (split, _) in _SPLITS.items()])


# --- columns ---------------------------------------------------------------------------------------
@query("select l_orderkey, l_linenumber::bigint as l_linenumber, l_quantity as qty, l_discount as price_off, l_extendedprice as action, l_tax as tax from lineitem")
def rename_and_select(spark, d):
    li = table(spark, d, "lineitem")
    nested = li.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), F.col("l_quantity").alias("observation.state.qty"), F.col("l_discount").alias("observation.state.price.off"), F.col("l_extendedprice").alias("act"), F.col("l_tax").alias("a.tax"), F.col("l_returnflag").alias("observation.flag"))
    return layout.features_of(layout.rename_features(nested, {"act": "action"}), ("double", "bigint"))


@query(f"with p as ({_POSES}) select vec_id, {', '.join(f'round(e{k} + 0.05::double * e{k + 3}, 6) + 0.0 as t{k}' for k in (1, 2, 3))} from p")
def scaled_target(spark, d):
    p = poses(spark, d).withColumn("t", signals.add_scaled(F.col("xyz"), F.col("rpy"), 0.05))
    return p.select("vec_id", *[rd(F.get("t", F.lit(k))).alias(f"t{k + 1}") for k in range(3)])


@query("with v as (select event_id, least(greatest(value / 100, 0), 1) as x from events) select event_id, round(0.01 / (1 - x * (1 - 0.01::double / 50)), 6) as metres from v")
def boundary_depth(spark, d):
    x = F.least(F.greatest(F.col("value") / 100, F.lit(0.0)), F.lit(1.0))
    return events(spark, d).select("event_id", F.round(so3.linear_depth(x, 0.01, 50.0), 6).alias("metres"))


# --- fits ------------------------------------------------------------------------------------------
def _det(m):
    return f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]}) - {m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]}) + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))"


_SUMS = ", ".join([f"sum(e{i} * e{j}) as m{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3)] + [f"sum(e{i} * e4) as r{i}" for i in (1, 2, 3)] + ["sum(e4 * e4) as yy"])
_MS = [[f"m{i}{j}" for j in (1, 2, 3)] for i in (1, 2, 3)]
_SOLVED = [f"{_det([[f'r{i}' if j == k else f'm{i}{j}' for j in (1, 2, 3)] for i in (1, 2, 3)])} / {_det(_MS)}" for k in (1, 2, 3)]


@query(f"""with p as ({_POSES}), edge as (select label, quantile_cont(e4, 0.05) as a, quantile_cont(e4, 0.95) as b from p group by 1),
s as (select p.label, {_SUMS} from p join edge using (label) where e4 between a and b group by 1), c as (select label, r1, r2, r3, yy, {', '.join(f'{x} as c{k}' for k, x in enumerate(_SOLVED))} from s)
select label, round(c0, 5) + 0.0 as c0, round(c1, 5) + 0.0 as c1, round(c2, 5) + 0.0 as c2, round((c0 * r1 + c1 * r2 + c2 * r3) / yy, 5) + 0.0 as r2 from c""")
def linear_fit_3d(spark, d):
    p = poses(spark, d).select("label", "xyz", F.get("rpy", F.lit(0)).alias("y"))
    out = stats.linear_fit3(p, ["label"], "xyz", "y", 0.05, 0.95)
    return out.select("label", *[rd(F.get("coefficients", F.lit(k)), 5).alias(f"c{k}") for k in range(3)], rd(F.col("r2"), 5).alias("r2"))


# --- kinematic checks ------------------------------------------------------------------------------
def _tip(a, b, c):
    return f"0.1 * cos({a}) + 0.2 * cos({a} + {b}) + 0.2 * cos({a} + {b} + {c})", f"0.1 * sin({a}) + 0.2 * sin({a} + {b}) + 0.2 * sin({a} + {b} + {c})"


def _far(x, y):
    return f"sqrt(({x} - e1) * ({x} - e1) + ({y} - e2) * ({y} - e2) + (0.15 - e3) * (0.15 - e3))"


_FAR3 = "sqrt((f1 - e1) * (f1 - e1) + (f2 - e2) * (f2 - e2) + (f3 - e3) * (f3 - e3))"


@query(f"""with p as ({_POSES}), x as (select *, {_tip('e17', 'e18', 'e19')[0]} as x, {_tip('e17', 'e18', 'e19')[1]} as y, {_tip('e20', 'e21', 'e22')[0]} as tx, {_tip('e20', 'e21', 'e22')[1]} as ty from p),
n as (select *, lead(x) over ({_P}) as nx, lead(y) over ({_P}) as ny, lead(e1) over ({_P}) as f1, lead(e2) over ({_P}) as f2, lead(e3) over ({_P}) as f3 from x),
m as (select *, coalesce({_FAR3} > 0.8, false) as moves, {_far('nx', 'ny')} as s, {_far('tx', 'ty')} as t from n), k as (select *, moves or coalesce(lag(moves) over ({_P}), false) as near from m)
select label, round(coalesce(avg(s) filter (where moves), avg(s)), 6) as state, round(coalesce(avg(t) filter (where near), avg(t)), 6) as target from k group by 1""")
def fk_residual(spark, d):
    p = poses(spark, d).withColumns({"j": F.slice("q", 1, 3), "a": F.slice("q", 4, 3)})
    out = kinematics.fk_residual(p, POSES, _PLANAR, "j", "a", "xyz", 0.8)
    return out.select("label", F.round("state", 6).alias("state"), F.round("target", 6).alias("target"))


@query(_NEXT.replace(f"lead(e1) over ({_P}) as f1", ", ".join(f"lead(e{k}) over ({_P}) as g{k}" for k in range(4, 11)) + f", lead(e1) over ({_P}) as f1") + " select vec_id, " + ", ".join(f"round(coalesce(g{k} - e{k}, 0), 6) + 0.0 as d{k}" for k in range(4, 11)) + ", " + ", ".join(f"round(coalesce({_MT[3 * i]} * (f1 - e1) + {_MT[3 * i + 1]} * (f2 - e2) + {_MT[3 * i + 2]} * (f3 - e3), 0), 5) + 0.0 as p{i}" for i in range(3)) + " from n")
def mixed_motion(spark, d):
    p = poses(spark, d).withColumn("m", so3.rpy_to_matrix(F.col("rpy")))
    out = trajectory.mixed_motion(p, POSES, "xyz", "rpy", "quat", "m")
    return out.select("vec_id", *[rd(F.get(c, F.lit(k))).alias(f"d{at + k}") for c, at, n in (("world_rpy", 4, 3), ("world_quat", 7, 4)) for k in range(n)], *[rd(F.get("gripper_xyz", F.lit(k)), 5).alias(f"p{k}") for k in range(3)])


# --- conversions, model deltas, camera -------------------------------------------------------------
_Q = f"with p as ({_POSES}), m as (select *, e7 as i, e8 as j, e9 as k, e10 as r, 2 / (e7 * e7 + e8 * e8 + e9 * e9 + e10 * e10) as s from p)"


@query(f"{_Q} select vec_id, " + ", ".join(f"round({_QUAT[3 * row + col]}, 6) + 0.0 as c{3 * col + row}" for col in range(2) for row in range(3)) + ", " + ", ".join(f"round({_QUAT[k]}, 6) + 0.0 as w{k}" for k in range(6)) + " from m")
def convert_rotations(spark, d):
    p = poses(spark, d).withColumns({"c": so3.convert_rotation(F.col("quat"), "quaternion", "rotation_6d"), "w": so3.convert_rotation(F.col("quat"), "quaternion", "rot6d_rows")})
    return p.select("vec_id", *[rd(F.get(c, F.lit(k))).alias(f"{c}{k}") for c in "cw" for k in range(6)])


_S9 = f"{_Q}, f as (select *, {', '.join(f'{x} as s{k}' for k, x in enumerate(_QUAT))}, {', '.join(f'{x} as m{k}' for k, x in enumerate(_INTRINSIC))} from m)"
_S, _ST = [f"s{k}" for k in range(9)], [f"s{3 * j + i}" for i in range(3) for j in range(3)]
_INTO = [f"({x})" for x in _sql_product([f"m{3 * j + i}" for i in range(3) for j in range(3)], _S)]


@query(f"{_S9} select vec_id, " + ", ".join(f"round(e{17 + i} + s{3 * i} * e1 + s{3 * i + 1} * e2 + s{3 * i + 2} * e3, 5) + 0.0 as world{i}" for i in range(3)) + ", " + ", ".join(f"round({_INTO[3 * i]} * e1 + {_INTO[3 * i + 1]} * e2 + {_INTO[3 * i + 2]} * e3, 5) + 0.0 as grip{i}" for i in range(3)) + " from f")
def model_deltas(spark, d):
    """A move of xyz given in the frame of the quaternion, as an absolute target and in the frame of the gripper."""
    p = poses(spark, d).withColumns({"now": so3.rpy_to_matrix(F.col("rpy")), "frame": so3.quaternion_to_matrix(F.col("quat")), "at": F.slice("q", 1, 3)})
    _, world = so3.world_pose_from_model_delta(F.col("now"), F.col("xyz"), F.col("now"), F.col("at"), F.col("frame"))
    _, grip = so3.gripper_delta_from_model_delta(F.col("now"), F.col("xyz"), F.col("now"), F.col("frame"))
    return p.select("vec_id", *[rd(F.get(world, F.lit(k)), 5).alias(f"world{k}") for k in range(3)], *[rd(F.get(grip, F.lit(k)), 5).alias(f"grip{k}") for k in range(3)])


@query("""with c as (select p_partkey, p_size * 10.0::double as h, p_size * 16.0::double as w, 30.0::double + p_size as fovy from part)
select p_partkey, round(0.5 * h / tan(radians(fovy) / 2), 4) as fx, round(0.5 * h / tan(radians(fovy) / 2), 4) as fy, w / 2 as cx, h / 2 as cy from c""")
def camera_intrinsics(spark, d):
    c = table(spark, d, "part").select("p_partkey", (F.col("p_size") * 10.0).alias("h"), (F.col("p_size") * 16.0).alias("w"), (F.col("p_size") + 30.0).alias("fovy"))
    k = c.withColumn("k", so3.camera_intrinsics(F.col("h"), F.col("w"), F.col("fovy")))
    return k.select("p_partkey", F.round(F.get("k", F.lit(0)), 4).alias("fx"), F.round(F.get("k", F.lit(4)), 4).alias("fy"), F.get("k", F.lit(2)).alias("cx"), F.get("k", F.lit(5)).alias("cy"))


@query(_RPY + f" select vec_id, {_sql_matrix('t', ['m0', '-m1', '-m2', 'm3', '-m4', '-m5', 'm6', '-m7', '-m8'])} from m")
def camera_axes(spark, d):
    p = poses(spark, d).withColumn("m", so3.rpy_to_matrix(F.col("rpy")))
    m, zero, one = F.col("m"), F.lit(0.0), F.lit(1.0)
    pose = F.concat(*[part for r in range(3) for part in (F.slice(m, 3 * r + 1, 3), F.array(zero))], F.array(zero, zero, zero, one))
    p = p.withColumn("c", so3.camera_axis_correction(pose)).withColumn("r", F.array(*[F.get("c", F.lit(4 * i + j)) for i in range(3) for j in range(3)]))
    return p.select("vec_id", *_matrix("t", F.col("r")))


# --- dataset rules by shape ------------------------------------------------------------------------
def _native(spark, d, observation, action):
    """embeddings as native steps of a given shape: columns of the structs (or a vector) by slices of the embedding."""
    e = table(spark, d, "embeddings").withColumn("v", F.transform("embedding", lambda x: x.cast("double")))
    cut = lambda a, n: F.slice("v", a, n) if n else F.get("v", F.lit(a - 1))
    struct = lambda shape: F.struct(*[cut(a, n).alias(c) for c, (a, n) in shape.items()]) if isinstance(shape, dict) else cut(*shape)
    return e.select("label", "vec_id", struct(observation).alias("observation"), struct(action).alias("action"))


def _flat(df, *columns):
    return df.select("vec_id", *[rd(F.get(c, F.lit(k)), 5).alias(f"{c}{k}") for c, n in columns for k in range(n)])


def _rounded(name, exprs):
    return ", ".join(f"round({x}, 5) + 0.0 as {name}{k}" for k, x in enumerate(exprs))


def _shaped(name, spark, d, observation, action):
    return registry.RULES[name].apply(_native(spark, d, observation, action), POSES)


@query(f"with p as ({_POSES}) select vec_id, {_rounded('action', [f'e{k}' for k in range(9, 16)])}, {_rounded('eef_state', [f'e{k}' for k in range(1, 7)])}, {_rounded('gripper_state', ['e8'])} from p")
def rule_sliced(spark, d):
    return _flat(_shaped("nyu_rot", spark, d, {"state": (1, 8)}, (9, 8)), ("action", 7), ("eef_state", 6), ("gripper_state", 1))


@query(f"with p as ({_POSES}) select vec_id, {_rounded('action', ['e9', 'e10', 'e11', 'e12', '0::double', '0::double', 'e15'])}, {_rounded('eef_state', ['e1', 'e2', 'e3', 'e4', '0::double', '0::double'])}, {_rounded('gripper_state', ['e8'])} from p")
def rule_padded(spark, d):
    return _flat(_shaped("robo_net", spark, d, {"state": (1, 8)}, (9, 7)), ("action", 7), ("eef_state", 6), ("gripper_state", 1))


@query(f"with p as ({_POSES}) select vec_id, {_rounded('action', [f'e{k}' for k in range(13, 19)] + ['1 - e19'])}, {_rounded('eef_state', ['e1', 'e2', 'e3', 'e8', 'e9', 'e10'])}, {_rounded('gripper_state', ['e10'])} from p")
def rule_inverted(spark, d):
    return _flat(_shaped("stanford_hydra", spark, d, {"state": (1, 12)}, (13, 7)), ("action", 7), ("eef_state", 6), ("gripper_state", 1))


@query(f"""with p as ({_POSES}), t as (select *, case when e7 < -0.1 then 1.0 when e7 > 0.1 then -1.0 end as mv from p),
g as (select *, coalesce(last_value(mv ignore nulls) over ({_P} rows between unbounded preceding and current row), -first_value(mv ignore nulls) over ({_P} rows between unbounded preceding and unbounded following), 1.0) / 2 + 0.5 as grip from t)
select vec_id, {_rounded('action', [f'e{k}' for k in range(1, 7)] + ['grip'])} from g""")
def rule_world_vector(spark, d):
    action = {"world_vector": (1, 3), "rotation_delta": (4, 3), "gripper_closedness_action": (7, 1)}
    return _flat(_shaped("kuka", spark, d, {"natural_language_instruction": (9, 0)}, action), ("action", 7))



def _quaternion_entries(i, j, k, r):
    names = {"i": i, "j": j, "k": k, "r": r}
    return ["".join(names.get(c, c) for c in x) for x in _QUAT]


_QA = _quaternion_entries("e12", "e13", "e14", "e15")


@query(f"""with p as ({_POSES}), q as (select *, 2 / (e12 * e12 + e13 * e13 + e14 * e14 + e15 * e15) as s from p)
select vec_id, {_rounded('action', ['e9', 'e10', 'e11', f'atan2({_QA[7]}, {_QA[8]})', f'asin(least(greatest(-({_QA[6]}), -1), 1))', f'atan2({_QA[3]}, {_QA[0]})', 'e16'])}, {_rounded('joint_state', [f'e{k}' for k in range(1, 8)])}, {_rounded('gripper_state', ['e8'])} from q""")
def rule_quaternion_action(spark, d):
    return _flat(_shaped("iamlab_pick_insert", spark, d, {"state": (1, 8)}, (9, 8)), ("action", 7), ("joint_state", 7), ("gripper_state", 1))


@query(f"""with p as ({_POSES}), r as (select *, row_number() over ({_P}) as i from p), k as (select * from r where i > 1),
n as (select *, {', '.join(f'lead(e{k}) over ({_P}) as n{k}' for k in range(1, 7))} from k)
select vec_id, {_rounded('action', [f'n{k} - e{k}' for k in range(1, 7)] + ['e15'])}, {_rounded('eef_state', [f'e{k}' for k in range(1, 7)])}, {_rounded('gripper_state', ['e8'])} from n where n1 is not null""")
def rule_relabelled(spark, d):
    action = {"world_vector": (9, 3), "rotation_delta": (12, 3), "open_gripper": (15, 0)}
    return _flat(_shaped("bridge_oxe", spark, d, {"state": (1, 8), "natural_language_instruction": (9, 0)}, action), ("action", 7), ("eef_state", 6), ("gripper_state", 1))
