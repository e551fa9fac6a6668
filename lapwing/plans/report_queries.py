"""Report, constraint and filter queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lapwing.datasets import BOXES_SQL, DIALOGUE_SQL, INTERVALS_SQL, boxes, dialogue, intervals, table
from lapwing.operators import constraints as cs
from lapwing.operators import filters as fl
from lapwing.operators import reports as rp
from lapwing.operators import timeline
from lapwing.plans.interval_queries import DAY, HOUR, _islands_sql
from lapwing.registry import query


@query(
    "a01_subtitle_lane",
    f"""WITH {BOXES_SQL}, d AS (SELECT frame % 50 AS g, (y1 + y2) / 2.0 AS c, CAST(y2 - y1 AS DOUBLE) AS h, score FROM bx), f AS (SELECT g, median(c) AS c0, median(h) AS h0 FROM d WHERE score >= 5 GROUP BY g),
    l AS (SELECT d.g, median(c) AS lane_center, median(h) AS lane_height, count(*) AS support FROM d JOIN f ON f.g = d.g WHERE abs(c - c0) <= h0 * 2.0 GROUP BY d.g)
    SELECT t.g, rows, lane_center, lane_height, support, support / CAST(rows AS DOUBLE) AS support_ratio FROM (SELECT g, count(*) AS rows FROM d GROUP BY g) t JOIN l ON l.g = t.g""",
)
def a01_subtitle_lane(spark, sf_dir):
    rows = boxes(spark, sf_dir).select((F.col("frame") % 50).alias("g"), ((F.col("y1") + F.col("y2")) / 2.0).alias("c"), (F.col("y2") - F.col("y1")).cast("double").alias("h"), "score")
    return rp.calibrate_lane(rows, ["g"], "c", "h", F.col("score") >= 5, 2.0)


@query("a02_residual_per_second", f"WITH {INTERVALS_SQL} SELECT kind, s // 1000000 // 3600 AS second, count(*) AS n, count(*) FILTER (WHERE e - s > {HOUR}) AS long_ones FROM iv GROUP BY kind, s // 1000000 // 3600")
def a02_residual_per_second(spark, sf_dir):
    return rp.per_second(intervals(spark, sf_dir), ["kind"], F.expr("start div 3600000000"), {"long_ones": F.col("end") - F.col("start") > HOUR})


@query(
    "a03_verify_checks",
    """SELECT l_returnflag, l_linestatus, bool_and(l_quantity > 0) AS positive, bool_and(l_discount <= 0.1) AS discount_ok, bool_and(l_extendedprice >= 1000) AS price_ok,
      bool_and(l_quantity > 0) AND bool_and(l_discount <= 0.1) AND bool_and(l_extendedprice >= 1000) AS passed FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def a03_verify_checks(spark, sf_dir):
    checks = {"positive": F.col("l_quantity") > 0, "discount_ok": F.col("l_discount") <= 0.1, "price_ok": F.col("l_extendedprice") >= 1000}
    return rp.all_hold(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], checks)


@query(
    "a04_metric_sets",
    """WITH g AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS got, count(*) AS items FROM events GROUP BY user_id)
    SELECT user_id, items, got = ['click', 'error', 'purchase', 'signup', 'view'] AND items = 5 AS exact,
      array_to_string(list_filter(['click', 'error', 'purchase', 'signup', 'view'], lambda x: NOT list_contains(got, x)), ',') AS missing, '' AS extra FROM g""",
)
def a04_metric_sets(spark, sf_dir):
    return rp.set_equals(table(spark, sf_dir, "events"), ["user_id"], "event_type", ["view", "click", "purchase", "signup", "error"])


@query(
    "a05_geometry_coverage",
    f"""WITH {BOXES_SQL}, p AS (SELECT frame // 64 AS v, frame % 64 AS at, ord, x1, y1, x2, y2 FROM bx WHERE score < 5),
    e AS (SELECT frame // 64 AS v, frame % 64 - 1 AS s, frame % 64 + 1 AS e, ord AS idx, x1 - 60 AS x1, y1 - 60 AS y1, x2 + 60 AS x2, y2 + 60 AS y2 FROM bx WHERE score >= 5),
    m AS (SELECT p.v, p.at, p.ord, bool_or(e.x1 <= p.x1 AND e.y1 <= p.y1 AND e.x2 >= p.x2 AND e.y2 >= p.y2) AS c FROM p JOIN e ON e.v = p.v AND p.at BETWEEN e.s AND e.e GROUP BY p.v, p.at, p.ord)
    SELECT p.v, p.at, p.ord, coalesce(c, false) AS contained FROM p LEFT JOIN m ON m.v = p.v AND m.at = p.at AND m.ord = p.ord""",
)
def a05_geometry_coverage(spark, sf_dir):
    b = boxes(spark, sf_dir).withColumns({"v": F.expr("frame div 64"), "at": F.col("frame") % 64})
    p = b.where("score < 5").select("v", "at", F.struct("at", "ord").alias("ord"), "x1", "y1", "x2", "y2")
    e = b.where("score >= 5").select("v", (F.col("at") - 1).alias("start"), (F.col("at") + 1).alias("end"), F.col("ord").alias("index"), *[(F.col(c) - 60).alias(c) for c in ("x1", "y1")], *[(F.col(c) + 60).alias(c) for c in ("x2", "y2")])
    return rp.contained_in_active(p, e, ["v"], 8).select("v", "at", F.col("ord.ord").alias("ord"), "contained")


@query(
    "a08_rect_diff",
    f"""WITH {BOXES_SQL}, d AS (SELECT frame, count(*) AS n, count(*) FILTER (WHERE x1 % 16 <> 0 OR y1 % 16 <> 0) AS changed, CAST(sum(abs(x1 % 16) + abs(y1 % 16)) AS BIGINT) AS delta FROM bx GROUP BY frame) SELECT * FROM d""",
)
def a08_rect_diff(spark, sf_dir):
    dx, dy = F.abs(F.col("x1") % 16), F.abs(F.col("y1") % 16)
    return boxes(spark, sf_dir).groupBy("frame").agg(F.count(F.lit(1)).alias("n"), F.count_if((dx != 0) | (dy != 0)).alias("changed"), F.sum(dx + dy).alias("delta"))


@query(
    "a12_manifest",
    "SELECT c_custkey, c_name, n_name, r_name, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def a12_manifest(spark, sf_dir):
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.join(n, "c_custkey", "left").select("c_custkey", "c_name", "n_name", "r_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


@query(
    "a13_status_partition",
    """SELECT o_orderstatus, CASE WHEN o_totalprice > 200000 THEN 'completed' WHEN o_custkey % 3 = 0 THEN 'cached' ELSE 'failed' END AS status, count(*) AS n, max(o_orderkey % 3 + 1) AS attempts FROM orders GROUP BY 1, 2""",
)
def a13_status_partition(spark, sf_dir):
    status = F.when(F.col("o_totalprice") > 200000, "completed").when(F.col("o_custkey") % 3 == 0, "cached").otherwise("failed")
    return rp.status_partition(table(spark, sf_dir, "orders").withColumn("a", F.col("o_orderkey") % 3 + 1), ["o_orderstatus"], status, "a")


@query(
    "a14_detectors",
    """SELECT event_type AS detector, count(*) AS n, count(DISTINCT user_id) AS users, min(value) AS lowest, max(value) AS highest FROM (SELECT * FROM events WHERE event_type = 'view' UNION ALL SELECT * FROM events WHERE event_type = 'click') GROUP BY 1""",
)
def a14_detectors(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    both = e.where("event_type = 'view'").unionByName(e.where("event_type = 'click'"))
    return both.groupBy(F.col("event_type").alias("detector")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.min("value").alias("lowest"), F.max("value").alias("highest"))


@query(
    "a15_widths",
    f"""WITH {BOXES_SQL}, w AS (SELECT frame, ord, x2 - x1 AS width FROM bx) SELECT frame, arg_max(ord, width * 1000000000000 - ord) AS widest, max(width) AS width, count(*) FILTER (WHERE width > 120) AS overflows FROM w GROUP BY frame""",
)
def a15_widths(spark, sf_dir):
    return rp.widest(boxes(spark, sf_dir), ["frame"], F.col("x2") - F.col("x1"), 120, "ord")


@query(
    "a17_i04_merge_candidates",
    f"""WITH {INTERVALS_SQL}, c AS (SELECT key, ord, kind AS source, s, e, (ord % 100) / 100.0 AS confidence, 'r' || CAST(ord % 4 AS VARCHAR) AS reason FROM iv WHERE kind IN ('view', 'click')),
    n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY s, e, ord) AS rn FROM c), r AS (SELECT *, max(e) OVER (PARTITION BY key ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM n),
    i AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + {HOUR} THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY rn ROWS UNBOUNDED PRECEDING) AS island FROM r),
    f AS (SELECT *, row_number() OVER (PARTITION BY key, island, reason ORDER BY rn) AS seen FROM i)
    SELECT key, min(s) AS start, max(e) AS "end", max(confidence) AS confidence, array_to_string(list_sort(list_distinct(list(source))), ',') AS sources, string_agg(CASE WHEN seen = 1 THEN reason END, '; ' ORDER BY rn) AS reasons FROM f GROUP BY key, island""",
)
def a17_i04_merge_candidates(spark, sf_dir):
    rows = intervals(spark, sf_dir).where("kind in ('view', 'click')")
    rows = rows.select("key", "ord", F.col("kind").alias("source"), "start", "end", ((F.col("ord") % 100) / 100.0).alias("confidence"), F.concat(F.lit("r"), (F.col("ord") % 4).cast("string")).alias("reason"))
    return rp.merge_candidates(rows, ["key"], HOUR)


def _second_look(spark, sf_dir):
    """Views are seen at once, clicks only once a cut of their key has ended before
    them; what has been cut is not seen again."""
    rows = intervals(spark, sf_dir).join(table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), (F.col("value") / 100).alias("score")), "ord")
    rows = rows.select("key", "ord", "kind", "start", "end", "score")

    def detect(cuts):
        if cuts is None:
            return rows.where("kind = 'view'")
        first = cuts.groupBy("key").agg(F.min("end").alias("_cut"))
        seen = rows.join(first, "key", "left").where("kind = 'view' or kind = 'click' and _cut <= start").drop("_cut")
        return seen.join(cuts.select("key", "ord"), ["key", "ord"], "left_anti")

    return timeline.audit_until_clean(detect, 0.8, 2)


_AUDIT_SQL = f"""WITH {INTERVALS_SQL}, d AS (SELECT iv.*, value / 100 AS score FROM iv JOIN events ON event_id = ord),
    p1 AS (SELECT * FROM d WHERE kind = 'view' AND score >= 0.8), c1 AS (SELECT key, min(e) AS c FROM p1 GROUP BY key),
    p2 AS (SELECT d.* FROM d JOIN c1 ON c1.key = d.key WHERE kind = 'click' AND c <= s AND score >= 0.8),
    cut AS (SELECT key, ord, e, 1 AS pass FROM p1 UNION ALL SELECT key, ord, e, 2 FROM p2), c2 AS (SELECT key, min(e) AS c FROM cut GROUP BY key)"""


@query("a11_audit_passes", f"{_AUDIT_SQL} SELECT key, ord, pass FROM cut")
def a11_audit_passes(spark, sf_dir):
    return _second_look(spark, sf_dir)[0].select("key", "ord", "pass")


@query("a11_left_over", f"{_AUDIT_SQL} SELECT d.key, d.ord, score >= 0.8 AS failed FROM d LEFT JOIN c2 ON c2.key = d.key WHERE (kind = 'view' OR kind = 'click' AND c <= s) AND d.ord NOT IN (SELECT ord FROM cut)")
def a11_left_over(spark, sf_dir):
    return _second_look(spark, sf_dir)[1].select("key", "ord", "failed")


@query("s15_newest", "SELECT event_id, user_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 40")
def s15_newest(spark, sf_dir):
    return table(spark, sf_dir, "events").orderBy(F.col("ts").desc(), "event_id").limit(40).select("event_id", "user_id", "ts")


@query("i29_i31_first_times", f"WITH {INTERVALS_SQL}, r AS (SELECT key, ord, (s + e) // 2 AS middle, row_number() OVER (PARTITION BY key ORDER BY s, ord) AS rank FROM iv) SELECT key, ord, middle, rank FROM r WHERE rank <= 4")
def i29_i31_first_times(spark, sf_dir):
    rows = rp.nearest_first(intervals(spark, sf_dir), ["key"], [F.col("start"), F.col("ord")], 4)
    return rows.select("key", "ord", F.expr("(start + end) div 2").alias("middle"), F.col("rank").cast("long").alias("rank"))


# --- constraints -----------------------------------------------------------


@query(
    "v01_sequence_violations",
    """WITH n AS (SELECT l_orderkey, l_linenumber, epoch_us(l_shipdate) AS s, epoch_us(l_shipdate) + CAST(l_quantity AS BIGINT) * 3600000000 AS e FROM lineitem),
    r AS (SELECT *, row_number() OVER w AS n, lag(e) OVER w AS pe FROM n WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, s, e))
    SELECT l_orderkey, l_linenumber, s, concat_ws(',', CASE WHEN l_linenumber <> n THEN 'index' END, CASE WHEN e <= s THEN 'empty' END, CASE WHEN s < pe THEN 'overlap' END) AS rules
    FROM r WHERE l_linenumber <> n OR e <= s OR coalesce(s < pe, false)""",
)
def v01_sequence_violations(spark, sf_dir):
    s = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', l_shipdate)")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", s.alias("s"), (s + F.col("l_quantity").cast("bigint") * HOUR).alias("e"))
    return cs.sequence_violations(rows, ["l_orderkey"], "l_linenumber", "s", "e", 1).select("l_orderkey", "l_linenumber", "s", F.array_join("rules", ",").alias("rules"))


@query(
    "v02_attempt_violations",
    """WITH g AS (SELECT l_orderkey, list_sort(list(l_linenumber - 1)) AS i, count(DISTINCT l_partkey) AS d, count(*) AS attempts FROM lineitem GROUP BY l_orderkey),
    p AS (SELECT l_orderkey, attempts, CASE WHEN i <> range(0, len(i)) THEN 'not_contiguous' WHEN attempts > 3 THEN 'too_many' WHEN d < attempts THEN 'repeated' END AS problem FROM g) SELECT * FROM p WHERE problem IS NOT NULL""",
)
def v02_attempt_violations(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("i", (F.col("l_linenumber") - 1).cast("long"))
    return cs.attempt_violations(rows, ["l_orderkey"], "i", 3, "l_partkey")


@query(
    "v03_equations",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, concat_ws(',', CASE WHEN l_partkey % 5 <> l_suppkey % 5 THEN 'onset' END, CASE WHEN l_linenumber % 2 <> l_suppkey % 2 THEN 'lag' END) AS wrong
    FROM lineitem WHERE l_partkey % 5 <> l_suppkey % 5 OR l_linenumber % 2 <> l_suppkey % 2""",
)
def v03_equations(spark, sf_dir):
    c = F.col
    out = cs.equation_violations(table(spark, sf_dir, "lineitem"), {"onset": (c("l_partkey") % 5, c("l_suppkey") % 5), "lag": ((c("l_linenumber") % 2).cast("long"), c("l_suppkey") % 2)})
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.array_join("wrong", ",").alias("wrong"))


@query(
    "v04_run_violations",
    f"""WITH {INTERVALS_SQL}, r AS (SELECT key, ord, s, e, lead(s) OVER (PARTITION BY key ORDER BY s, e, ord) AS ns FROM iv),
    g AS (SELECT key, bool_and(s < e AND coalesce(e < ns, true)) AS ok, min(s) AS a, arg_max(e, s * 1000 + ord) AS b, max(e) AS m FROM r GROUP BY key)
    SELECT key, CASE WHEN NOT ok THEN 'unordered' WHEN b <> m THEN 'unbound' ELSE '' END AS problem FROM g""",
)
def v04_run_violations(spark, sf_dir):
    runs = F.transform(F.array_sort(F.collect_list(F.struct("start", "end", "ord"))), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    rows = intervals(spark, sf_dir).groupBy("key").agg(runs.alias("runs"), F.min("start").alias("a"), F.max("end").alias("b"))
    return rows.select("key", cs.run_violations(F.col("runs"), F.col("a"), F.col("b")).alias("problem"))


_STATES = ["queued", "downloading", "detecting", "inpainting", "encoding_clean", "repairing_clean", "completed", "failed"]


def _job_states(spark, sf_dir):
    """Events of a user as moves between states, most of them wrong."""
    state = F.element_at(F.array(*[F.lit(s) for s in _STATES]), ((F.col("event_id") % 8) + 1).cast("int"))
    return table(spark, sf_dir, "events").select("user_id", "event_id", state.alias("state"))


_JOB_SQL = "st AS (SELECT user_id, event_id, [" + ", ".join(f"'{s}'" for s in _STATES) + "][CAST(event_id % 8 + 1 AS INT)] AS state FROM events)"
_EDGE_SQL = "ed(previous, state) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, to in cs.TRANSITIONS.items() for b in [*to, "failed", "cancelled"]) + ")"


@query(
    "v05_transition_violations",
    f"""WITH {_JOB_SQL}, {_EDGE_SQL}, m AS (SELECT user_id, event_id, state, lag(state) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM st),
    u AS (SELECT *, count(*) OVER (PARTITION BY user_id, state ORDER BY event_id) AS used FROM m WHERE previous IS NOT NULL),
    p AS (SELECT u.user_id, u.event_id, u.previous, u.state, CASE WHEN ed.state IS NULL THEN 'not_allowed' WHEN u.state = 'repairing_clean' AND used > 2 THEN 'budget_exhausted' END AS problem
      FROM u LEFT JOIN ed ON ed.previous = u.previous AND ed.state = u.state) SELECT * FROM p WHERE problem IS NOT NULL""",
)
def v05_transition_violations(spark, sf_dir):
    return cs.transition_violations(_job_states(spark, sf_dir), ["user_id"], "event_id", {"repairing_clean": 2}).select("user_id", "event_id", "previous", "state", "problem")


@query("v06_final_states", f"WITH {_JOB_SQL} SELECT user_id, event_id, state IN ({', '.join(repr(s) for s in cs.FINAL)}) AS final FROM st")
def v06_final_states(spark, sf_dir):
    return _job_states(spark, sf_dir).select("user_id", "event_id", cs.is_final(F.col("state")).alias("final"))


@query(
    "v30_closed_graph",
    """WITH e AS (SELECT o_orderstatus || o_orderpriority[1] AS a, o_orderpriority[1] || o_orderstatus AS b, o_orderkey % 7 AS k FROM orders),
    st AS (SELECT DISTINCT a AS state, a LIKE 'F%' AS final FROM e), g AS (SELECT DISTINCT a, b FROM e)
    SELECT DISTINCT b AS state, 'unknown_target' AS problem FROM g WHERE b NOT IN (SELECT state FROM st)
    UNION ALL SELECT DISTINCT a, 'final_can_be_left' FROM g JOIN st ON state = a WHERE final""",
)
def v30_closed_graph(spark, sf_dir):
    """A graph with planted faults: the moves are made of the orders' columns."""
    o = table(spark, sf_dir, "orders").select("o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("p"))
    moves = o.select(F.concat("o_orderstatus", "p").alias("previous"), F.concat("p", "o_orderstatus").alias("state")).distinct()
    states = moves.select(F.col("previous").alias("state"), F.col("previous").startswith("F").alias("final")).distinct()
    return cs.graph_problems(moves, states)


@query(
    "v07_status_fields",
    """WITH d AS (SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'open' ELSE 'labelled' END AS state, quality, nullif(source, 'src0') AS source FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
    SELECT doc_id, state, concat_ws(',', CASE WHEN state = 'labelled' AND source IS NULL THEN 'missing_source' END, CASE WHEN state = 'open' AND source IS NOT NULL THEN 'forbidden_source' END) AS problems
    FROM d WHERE (state = 'labelled' AND source IS NULL) OR (state = 'open' AND source IS NOT NULL)""",
)
def v07_status_fields(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    d = d.select("doc_id", F.when(F.col("quality").isNull(), "open").otherwise("labelled").alias("state"), F.nullif("source", F.lit("src0")).alias("source"))
    out = cs.conditional_fields(d, "state", {"labelled": ["source"]}, {"open": ["source"]})
    return out.select("doc_id", "state", F.array_join("problems", ",").alias("problems"))


@query(
    "v08_v09_callbacks",
    f"""WITH {_JOB_SQL} SELECT st.user_id, st.event_id, regexp_matches('job.' || state, '^job[.][a-z_]+$') AS name_ok, e.event_type = CASE WHEN st.event_id % 2 = 0 THEN 'view' ELSE e.event_type END AS consistent FROM st JOIN events e ON e.event_id = st.event_id""",
)
def v08_v09_callbacks(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    rows = _job_states(spark, sf_dir).join(e, "event_id")
    expected = F.when(F.col("event_id") % 2 == 0, "view").otherwise(F.col("event_type"))
    return rows.select("user_id", "event_id", F.concat(F.lit("job."), "state").rlike("^job[.][a-z_]+$").alias("name_ok"), (F.col("event_type") == expected).alias("consistent"))


@query(
    "v11_error_table",
    """WITH sem(code, stage, retryable) AS (VALUES ('view', 0, true), ('click', 1, false), ('purchase', 2, true), ('signup', 0, false))
    SELECT event_id, CASE WHEN code IS NULL THEN 'unknown_code' WHEN stage <> user_id % 3 THEN 'stage' WHEN retryable <> (value > 50) THEN 'retryable' ELSE '' END AS problem FROM events LEFT JOIN sem ON code = event_type""",
)
def v11_error_table(spark, sf_dir):
    sem = spark.createDataFrame([("view", 0, True), ("click", 1, False), ("purchase", 2, True), ("signup", 0, False)], "event_type string, stage int, retryable boolean")
    rows = table(spark, sf_dir, "events").join(F.broadcast(sem), "event_type", "left")
    problem = F.when(F.col("stage").isNull(), "unknown_code").when(F.col("stage") != F.col("user_id") % 3, "stage").when(F.col("retryable") != (F.col("value") > 50), "retryable")
    return rows.select("event_id", problem.otherwise("").alias("problem"))


@query("v16_independent", "SELECT o_orderkey, len(list_distinct([o_orderkey % 3, o_custkey % 3, (o_orderkey + o_custkey) % 5])) = 3 AS independent FROM orders")
def v16_independent(spark, sf_dir):
    a, b = F.col("o_orderkey"), F.col("o_custkey")
    return cs.distinct_parties(table(spark, sf_dir, "orders"), "o_orderkey", [a % 3, b % 3, (a + b) % 5])


@query(
    "v20_approval_window",
    f"""WITH {INTERVALS_SQL}, p AS (SELECT key, ord, CASE WHEN (e - s) * 40 - 60000000 <= 0 THEN 'not_after' WHEN (e - s) * 40 - 60000000 > {7 * DAY} THEN 'too_long' END AS problem FROM iv) SELECT * FROM p WHERE problem IS NOT NULL""",
)
def v20_approval_window(spark, sf_dir):
    rows = intervals(spark, sf_dir).withColumn("expires", F.col("start") + (F.col("end") - F.col("start")) * 40 - 60000000)
    return cs.window_violations(rows, "start", "expires").select("key", "ord", "problem")


@query("v21_same_json", "SELECT event_id, NOT contains(props, '1') AS same FROM events")
def v21_same_json(spark, sf_dir):
    from lapwing.functions import hashing as hs

    other = F.replace("props", F.lit("1"), F.lit("1.0"))
    return table(spark, sf_dir, "events").select("event_id", hs.same_document("props", other).alias("same"))


@query(
    "v26_v27_repeated_refs",
    """SELECT l_orderkey, count(*) - count(DISTINCT (l_partkey, l_suppkey)) AS repeated_refs, count(*) - count(DISTINCT l_suppkey) AS repeated_digests FROM lineitem GROUP BY l_orderkey HAVING count(*) > count(DISTINCT l_suppkey)""",
)
def v26_v27_repeated_refs(spark, sf_dir):
    return cs.repeated_refs(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_partkey", "l_suppkey"], "l_suppkey")


@query(
    "v31_v32_ranges",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linenumber * 10 < l_linenumber * 10 + l_quantity AND l_linenumber * 10 <= l_suppkey % 70 AND l_suppkey % 70 < l_linenumber * 10 + l_quantity AS valid FROM lineitem""",
)
def v31_v32_ranges(spark, sf_dir):
    a, b, s = F.col("l_linenumber") * 10, F.col("l_linenumber") * 10 + F.col("l_quantity"), F.col("l_suppkey") % 70
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", ((a < b) & (a <= s) & (s < b)).alias("valid"))


# --- filters ---------------------------------------------------------------


@query(
    "f07_lane_reasons",
    f"""WITH {BOXES_SQL}, m AS (SELECT frame, ord, (y1 + y2) / 2.0 AS c, y2 - y1 AS h FROM bx)
    SELECT frame, ord, concat_ws(',', CASE WHEN abs(c - 360) > 40 * 0.5 THEN 'center_off_lane' END, CASE WHEN h < 20 THEN 'too_low' END, CASE WHEN h > 60 THEN 'too_high' END) AS reasons FROM m""",
)
def f07_lane_reasons(spark, sf_dir):
    c, h = (F.col("y1") + F.col("y2")) / 2.0, F.col("y2") - F.col("y1")
    return boxes(spark, sf_dir).select("frame", "ord", F.array_join(fl.lane_reasons(c, h, F.lit(360.0), F.lit(40.0)), ",").alias("reasons"))


@query(
    "f08_f09_cue_violations",
    f"""WITH {DIALOGUE_SQL}, c AS (SELECT conv_id, ord, text, greatest(0, least(s, 800)) AS s, greatest(0, least(e, 800)) AS e FROM dl), n AS (SELECT *, lag(s) OVER w AS ps, row_number() OVER w - 1 AS n FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY ord))
    SELECT conv_id, ord, CASE WHEN length(trim(text)) = 0 THEN 'empty_text' WHEN e <= s THEN 'out_of_range' WHEN s < ps THEN 'unsorted' WHEN ord <> n THEN 'index_gap' ELSE '' END AS reason FROM n""",
)
def f08_f09_cue_violations(spark, sf_dir):
    return fl.cue_violations(dialogue(spark, sf_dir), ["conv_id"], F.lit(800)).select("conv_id", "ord", "reason")


@query("f10_f17_parse_spans", f"WITH {INTERVALS_SQL} SELECT key, ord, greatest(0, s - 1704500000000000) AS start, e - 1704500000000000 AS \"end\", least(1.0, greatest(0.0, (ord % 150) / 100.0)) AS confidence FROM iv WHERE e - 1704500000000000 > greatest(0, s - 1704500000000000)")
def f10_f17_parse_spans(spark, sf_dir):
    base = 1704500000000000
    rows = intervals(spark, sf_dir).select("key", "ord", F.greatest(F.lit(0), F.col("start") - base).alias("start"), (F.col("end") - base).alias("end"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("ord") % 150 / 100.0)).alias("confidence"))
    return rows.where("end > start")


@query("f20_request_value", "SELECT doc_id, coalesce(nullif(nullif(source, 'src3'), ''), 'default') AS value FROM documents")
def f20_request_value(spark, sf_dir):
    given = F.nullif(F.nullif("source", F.lit("src3")), F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(given, F.lit("default")).alias("value"))
