"""Scalar functions of time and number, over ``events`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapwing.datasets import BOXES_SQL, INTERVALS_SQL, boxes, intervals, table
from lapwing.functions import geometry as geo
from lapwing.functions import timefmt as tf
from lapwing.functions.geometry import Box
from lapwing.registry import query

DAY_S = 86400

_TEXT_SQL = """txt AS (SELECT event_id, CASE event_id % 7
    WHEN 0 THEN lpad(CAST(event_id % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') || ':' || CAST(event_id % 53 AS VARCHAR) || ',5'
    WHEN 1 THEN CAST(event_id % 60 AS VARCHAR) || ':' || CAST(event_id % 59 AS VARCHAR)
    WHEN 2 THEN CAST(event_id AS VARCHAR) || '.25' WHEN 3 THEN '' WHEN 4 THEN '1:2:3:4' WHEN 5 THEN 'x:1' ELSE ' ' || CAST(event_id AS VARCHAR) || ' ' END AS t FROM events)"""


def _texts(spark, sf_dir):
    i = F.col("event_id")
    s = lambda m: (i % m).cast("string")
    t = (
        F.when(i % 7 == 0, F.concat(F.lpad(s(24), 2, "0"), F.lit(":"), F.lpad(s(60), 2, "0"), F.lit(":"), s(53), F.lit(",5")))
        .when(i % 7 == 1, F.concat(s(60), F.lit(":"), s(59)))
        .when(i % 7 == 2, F.concat(i.cast("string"), F.lit(".25")))
        .when(i % 7 == 3, "").when(i % 7 == 4, "1:2:3:4").when(i % 7 == 5, "x:1")
        .otherwise(F.concat(F.lit(" "), i.cast("string"), F.lit(" ")))
    )
    return table(spark, sf_dir, "events").select("event_id", t.alias("t"))


@query(
    "t01_to_seconds",
    f"""WITH {_TEXT_SQL}, p AS (SELECT event_id, replace(trim(t), ',', '.') AS t, string_split(replace(trim(t), ',', '.'), ':') AS parts FROM txt)
    SELECT event_id, CASE WHEN length(t) = 0 OR len(parts) > 3 THEN NULL
      WHEN len(parts) = 1 THEN TRY_CAST(parts[1] AS DOUBLE)
      WHEN len(parts) = 2 THEN TRY_CAST(parts[1] AS DOUBLE) * 60 + TRY_CAST(parts[2] AS DOUBLE)
      ELSE (TRY_CAST(parts[1] AS DOUBLE) * 60 + TRY_CAST(parts[2] AS DOUBLE)) * 60 + TRY_CAST(parts[3] AS DOUBLE) END AS seconds FROM p""",
)
def t01_to_seconds(spark, sf_dir):
    return _texts(spark, sf_dir).select("event_id", tf.to_seconds(F.col("t")).alias("seconds"))


@query(
    "t02_t09_time_texts",
    f"""WITH {INTERVALS_SQL}, x AS (SELECT key, ord, s // 1000 % 500000000 AS ms FROM iv), y AS (SELECT key, ord, ms, ms // 1000 AS sec, ms // 10 AS cs FROM x),
    z AS (SELECT *, (ms % 1000) // 10 + CASE WHEN ms % 10 > 5 OR (ms % 10 = 5 AND ((ms % 1000) // 10) % 2 = 1) THEN 1 ELSE 0 END AS cc FROM y)
    SELECT key, ord,
      printf('%02d:%02d:%02d', sec // 3600, sec % 3600 // 60, sec % 60) AS hms,
      printf('%02d:%02d:%02d,%03d', ms // 3600000, ms % 3600000 // 60000, ms % 60000 // 1000, ms % 1000) AS srt,
      printf('%d:%02d:%02d.%02d', cs // 360000, cs % 360000 // 6000, cs % 6000 // 100, cs % 100) AS ass,
      printf('%d:%02d:%02d.%02d', ms // 3600000, ms % 3600000 // 60000, ms % 60000 // 1000 + CASE WHEN cc >= 100 THEN 1 ELSE 0 END, CASE WHEN cc >= 100 THEN cc - 100 ELSE cc END) AS ass_short,
      printf('%02d:%02d', sec // 60, sec % 60) AS clock FROM z""",
)
def t02_t09_time_texts(spark, sf_dir):
    ms = F.expr("start div 1000 % 500000000")
    rows = intervals(spark, sf_dir).select("key", "ord", ms.alias("ms")).withColumns({"sec": F.expr("ms div 1000"), "cs": F.expr("ms div 10")})
    return rows.select(
        "key", "ord", tf.hms(F.col("sec")).alias("hms"), tf.srt_time(F.col("ms")).alias("srt"), tf.ass_time(F.col("cs")).alias("ass"),
        tf.ass_time_short_carry(F.col("ms")).alias("ass_short"), tf.clock(F.col("sec")).alias("clock"),
    )


@query(
    "t10_publish_at",
    """WITH p AS (SELECT o_orderkey, o_orderkey % 40 AS part FROM orders), n AS (SELECT o_orderkey, part - 13 AS n FROM p)
    SELECT o_orderkey, CASE WHEN n < 0 THEN '' ELSE strftime(TIMESTAMP '2026-08-26 00:00:00' + to_days(CAST(n // 2 AS INT))
      + CASE WHEN n % 2 = 0 THEN INTERVAL 690 MINUTE ELSE INTERVAL 1110 MINUTE END - INTERVAL 420 MINUTE, '%Y-%m-%dT%H:%M:%SZ') END AS publish_at FROM n""",
)
def t10_publish_at(spark, sf_dir):
    part = F.col("o_orderkey") % 40
    return table(spark, sf_dir, "orders").select("o_orderkey", tf.publish_at(part, 13, "2026-08-26", ["11:30", "18:30"], 420).alias("publish_at"))


@query(
    "t11_rfc3339",
    """WITH x AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
      WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S+07:00') WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.250+07:00') ELSE '2024-13-01T00:00:00Z' END AS t FROM events)
    SELECT event_id, t, regexp_matches(t, '^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$')
      AND TRY_CAST(left(t, 10) AS DATE) IS NOT NULL AS valid FROM x""",
)
def t11_rfc3339(spark, sf_dir):
    i, f = F.col("event_id"), lambda p: F.date_format("ts", p)
    t = F.when(i % 5 == 0, F.concat(f("yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).when(i % 5 == 1, f("yyyy-MM-dd'T'HH:mm:ss"))
    t = t.when(i % 5 == 2, F.concat(f("yyyy-MM-dd HH:mm:ss"), F.lit("+07:00"))).when(i % 5 == 3, F.concat(f("yyyy-MM-dd'T'HH:mm:ss"), F.lit(".250+07:00")))
    rows = table(spark, sf_dir, "events").select("event_id", t.otherwise("2024-13-01T00:00:00Z").alias("t"))
    return rows.select("event_id", "t", tf.rfc3339_ok(F.col("t")).alias("valid"))


@query(
    "t12_fraction_order",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_partkey AS HUGEINT) * l_orderkey < CAST(l_suppkey AS HUGEINT) * (l_linenumber + 1) AS less FROM lineitem""",
)
def t12_fraction_order(spark, sf_dir):
    a = F.concat_ws("/", F.col("l_partkey").cast("string"), (F.col("l_linenumber") + 1).cast("string"))
    b = F.concat_ws("/", F.col("l_suppkey").cast("string"), F.col("l_orderkey").cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", tf.fraction_less(a, b).alias("less"))


@query(
    "t13_clamp_box",
    f"""WITH {BOXES_SQL}, c AS (SELECT frame, ord, greatest(0, least(1279, CAST(floor(x1 * 1.5 - 90.25) AS BIGINT))) AS x1, greatest(0, least(719, CAST(floor(y1 * 1.25 - 40.5) AS BIGINT))) AS y1,
      greatest(0, least(1280, CAST(ceil(x2 * 1.5 - 90.25) AS BIGINT))) AS x2, greatest(0, least(720, CAST(ceil(y2 * 1.25 - 40.5) AS BIGINT))) AS y2 FROM bx)
    SELECT frame, ord, x1, y1, x2, y2 FROM c WHERE x2 - x1 >= 4 AND y2 - y1 >= 4""",
)
def t13_clamp_box(spark, sf_dir):
    c = lambda v, k, d: F.col(v) * k - d
    box = tf.clamp_box(c("x1", 1.5, 90.25), c("y1", 1.25, 40.5), c("x2", 1.5, 90.25), c("y2", 1.25, 40.5), 1280, 720)
    return boxes(spark, sf_dir).select("frame", "ord", box.alias("b")).where("b is not null").select("frame", "ord", "b.*")


@query(
    "t14_bounded_range",
    """WITH x AS (SELECT o_orderkey, o_orderkey % 900 AS duration, o_custkey % 700 - 50 AS st, (o_orderkey * 7) % 200 AS longest FROM orders)
    SELECT o_orderkey, greatest(st, 0) AS start, CASE WHEN longest > 0 THEN least(duration, greatest(st, 0) + longest) ELSE duration END AS "end",
      CASE WHEN greatest(st, 0) >= duration THEN 'start beyond duration' WHEN longest > 0 AND longest < 60 THEN 'range too short' ELSE '' END AS error FROM x""",
)
def t14_bounded_range(spark, sf_dir):
    r = tf.bounded_range(F.col("o_orderkey") % 900, F.col("o_custkey") % 700 - 50, F.col("o_orderkey") * 7 % 200)
    return table(spark, sf_dir, "orders").select("o_orderkey", r.alias("r")).select("o_orderkey", "r.start", "r.end", F.coalesce("r.error", F.lit("")).alias("error"))


@query(
    "t15_pick_segment",
    """WITH x AS (SELECT o_orderkey, CAST(o_orderkey % 300 + 20 AS DOUBLE) AS d, CAST(o_custkey % 200 - 20 AS DOUBLE) AS a0, CAST(o_custkey % 200 - 20 + o_orderkey % 97 AS DOUBLE) AS b0, 1.25 AS sp FROM orders),
    y AS (SELECT *, (b0 <= greatest(a0, 0.0) + 1.0) OR b0 > d + 0.5 AS bad FROM x),
    z AS (SELECT *, CASE WHEN bad THEN 0.0 ELSE greatest(a0, 0.0) END AS a, least(CASE WHEN bad THEN least(d, 45.0 * sp) ELSE b0 END, d) AS b FROM y),
    w AS (SELECT *, (b - a) / sp AS ln, least(d, a + 35.0 * sp) AS grown FROM z)
    SELECT o_orderkey, CASE WHEN ln < 35.0 AND ln <= 45.0 AND (grown - a) / sp < 35.0 AND a > 0 THEN greatest(0.0, grown - 35.0 * sp) ELSE a END AS t0,
      least(CASE WHEN ln > 45.0 THEN a + 45.0 * sp WHEN ln < 35.0 THEN grown ELSE b END, d) AS t1 FROM w""",
)
def t15_pick_segment(spark, sf_dir):
    d, a = (F.col("o_orderkey") % 300 + 20).cast("double"), (F.col("o_custkey") % 200 - 20).cast("double")
    b = (F.col("o_custkey") % 200 - 20 + F.col("o_orderkey") % 97).cast("double")
    return table(spark, sf_dir, "orders").select("o_orderkey", tf.pick_segment(d, a, b, F.lit(1.25)).alias("s")).select("o_orderkey", "s.*")


@query("t16_last_decodable", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, greatest(0.0, least(l_quantity, 30.0 - 1.0 / 8.0)) AS at FROM lineitem")
def t16_last_decodable(spark, sf_dir):
    at = tf.last_decodable(F.col("l_quantity"), F.lit(30.0), F.lit(8.0))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", at.alias("at"))


@query(
    "t17_ratio_pair",
    """WITH x AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount * 5 AS a, l_tax * 20 - 0.5 AS b FROM lineitem),
    y AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, greatest(0.0, least(1.0, a)) AS a, greatest(0.0, least(1.0, b)) AS b FROM x)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, least(a, b) AS lo, greatest(a, b) AS hi FROM y""",
)
def t17_ratio_pair(spark, sf_dir):
    text = F.concat((F.col("l_discount") * 5).cast("string"), F.lit(" , "), (F.col("l_tax") * 20 - 0.5).cast("string"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", tf.ratio_pair(text).alias("p"))
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.get("p", F.lit(0)).alias("lo"), F.get("p", F.lit(1)).alias("hi"))


@query("t18_tail_adjustment", "SELECT o_orderkey, greatest(0, o_custkey - o_orderkey) AS pad, greatest(0, o_orderkey - o_custkey) AS trim FROM orders")
def t18_tail_adjustment(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", tf.tail_adjustment(F.col("o_orderkey"), F.col("o_custkey")).alias("t")).select("o_orderkey", "t.*")


@query(
    "t19_voice_fit",
    """WITH x AS (SELECT o_orderkey, (o_custkey * 37) % 3000 AS delay, (o_orderkey * 13) % 3000 AS dur FROM orders), y AS (SELECT *, greatest(0, 3000 - greatest(delay, 0)) AS room FROM x),
    z AS (SELECT *, CASE WHEN dur - room <= 0 THEN NULL WHEN dur - room > 1000 OR room <= 50 THEN 'ends beyond the video' WHEN dur * 1000 > room * 1020 THEN 'above the micro-fit limit' END AS error FROM y)
    SELECT o_orderkey, CASE WHEN dur - room > 0 AND error IS NULL THEN room ELSE -1 END AS target_ms, coalesce(error, '') AS error FROM z""",
)
def t19_voice_fit(spark, sf_dir):
    f = tf.voice_fit(F.col("o_custkey") * 37 % 3000, F.col("o_orderkey") * 13 % 3000, F.lit(3000).cast("bigint"))
    return table(spark, sf_dir, "orders").select("o_orderkey", f.alias("f")).select("o_orderkey", F.coalesce("f.target_ms", F.lit(-1)).alias("target_ms"), F.coalesce("f.error", F.lit("")).alias("error"))


@query("t20_voice_start", f"WITH {INTERVALS_SQL} SELECT key, ord, greatest(0, s - 1705000000000000) AS start FROM iv")
def t20_voice_start(spark, sf_dir):
    return intervals(spark, sf_dir).select("key", "ord", tf.voice_start(F.col("start") - 1705000000000000).alias("start"))


@query(
    "t21_seconds_list",
    """WITH x AS (SELECT event_id, CAST(event_id AS VARCHAR) || ', x,' || CAST(user_id AS VARCHAR) || '.5,, 7 ' AS t FROM events)
    SELECT event_id, unnest(list_filter(list_transform(string_split(t, ','), lambda p: TRY_CAST(trim(p) AS DOUBLE)), lambda v: v IS NOT NULL)) AS seconds FROM x""",
)
def t21_seconds_list(spark, sf_dir):
    t = F.concat(F.col("event_id").cast("string"), F.lit(", x,"), F.col("user_id").cast("string"), F.lit(".5,, 7 "))
    return table(spark, sf_dir, "events").select("event_id", F.explode(tf.seconds_list(t)).alias("seconds"))


@query(
    "t22_masks",
    """WITH x AS (SELECT s_suppkey, s_suppkey % 600 AS a FROM supplier)
    SELECT s_suppkey, 128 AS x1, 576 AS y1, 1152 AS x2, 648 AS y2 FROM x UNION ALL
    SELECT s_suppkey, a, 10, least(1280, a + 300), 60 FROM x""",
)
def t22_masks(spark, sf_dir):
    a = (F.col("s_suppkey") % 600).cast("string")
    text = F.concat(F.lit("0.1, 0.8,0.9,0.9; 1,2 ;x;"), a, F.lit(",10,"), (F.col("s_suppkey") % 600 + 300).cast("string"), F.lit(",60;5,5,7,7"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(tf.masks(text, 1280, 720)).alias("m")).select("s_suppkey", "m.*")


# --- rectangles ------------------------------------------------------------

_PAIRS = f"WITH {BOXES_SQL}, p AS (SELECT a.frame, a.ord, b.ord AS other, a.x1, a.y1, a.x2, a.y2, b.x1 AS r_x1, b.y1 AS r_y1, b.x2 AS r_x2, b.y2 AS r_y2 FROM bx a JOIN bx b ON a.frame = b.frame AND a.ord < b.ord)"
_INTER = "greatest(0, least(x2, r_x2) - greatest(x1, r_x1)) * greatest(0, least(y2, r_y2) - greatest(y1, r_y1))"
_AREA, _RAREA = "(x2 - x1) * (y2 - y1)", "(r_x2 - r_x1) * (r_y2 - r_y1)"


def _pairs(spark, sf_dir):
    """Pairs of boxes of one frame; a frame has at most a few."""
    b = boxes(spark, sf_dir)
    r = b.select("frame", *[F.col(c).alias(f"r_{c}" if c != "ord" else "other") for c in b.columns if c not in ("frame", "score")])
    return b.join(r, "frame").where("ord < other")


@query(
    "b01_b12_pair_geometry",
    _PAIRS + f""", q AS (SELECT *, {_INTER} AS inter FROM p)
    SELECT frame, ord, other, CASE WHEN inter > 0 THEN inter / CAST(greatest(1, {_AREA}) + greatest(1, {_RAREA}) - inter AS DOUBLE) ELSE 0.0 END AS iou,
      inter / CAST(greatest(1, {_AREA} + {_RAREA} - inter) AS DOUBLE) AS iou2,
      CASE WHEN least(x2, r_x2) > greatest(x1, r_x1) AND least(y2, r_y2) > greatest(y1, r_y1) THEN greatest(x1, r_x1) ELSE -1 END AS common_x1,
      x1 <= r_x1 AND y1 <= r_y1 AND x2 >= r_x2 AND y2 >= r_y2 AS contains,
      inter / CAST(greatest(1, {_AREA} + {_RAREA} - inter) AS DOUBLE) >= 0.25 OR greatest(0, x1 - r_x2, r_x1 - x2, y1 - r_y2, r_y1 - y2) <= 24 AS near FROM q""",
)
def b01_b12_pair_geometry(spark, sf_dir):
    a, b = Box(), Box("r_")
    return _pairs(spark, sf_dir).select(
        "frame", "ord", "other", geo.iou(a, b).alias("iou"), geo.iou_floored_union(a, b).alias("iou2"), F.coalesce(geo.intersect(a, b)["x1"], F.lit(-1)).alias("common_x1"),
        geo.contains(a, b).alias("contains"), geo.near(a, b, 0.25, 24).alias("near"),
    )


@query(
    "b03_union_box",
    f"WITH {BOXES_SQL} SELECT frame, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, count(*) AS n FROM bx GROUP BY frame",
)
def b03_union_box(spark, sf_dir):
    ends = [F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2")]
    return boxes(spark, sf_dir).groupBy("frame").agg(*ends, F.count(F.lit(1)).alias("n"))


@query(
    "b08_b13_grown_boxes",
    f"""WITH {BOXES_SQL}, w AS (SELECT *, least(1280, greatest(x2 - x1, 200)) AS gw, least(720, greatest(y2 - y1, 60)) AS gh FROM bx)
    SELECT frame, ord, greatest(0, x1 - 20) AS x1, greatest(0, y1 - 7) AS y1, least(1280, x2 + 20) AS x2, least(720, y2 + 7) AS y2,
      greatest(0, least(CAST(floor((x1 + x2 - gw) / 2.0) AS BIGINT), 1280 - gw)) AS grown_x1, greatest(0, least(CAST(floor((y1 + y2 - gh) / 2.0) AS BIGINT), 720 - gh)) AS grown_y1,
      (x1 + x2) / 2.0 / 1280 BETWEEN 0.15 AND 0.85 AND (y1 + y2) / 2.0 / 720 BETWEEN 0.55 AND 0.90 AS in_band FROM w""",
)
def b08_b13_grown_boxes(spark, sf_dir):
    b = Box()
    d, g = geo.dilate(b, 20, 7, 1280, 720), geo.grow_to(b, F.lit(200), F.lit(60), 1280, 720)
    out = boxes(spark, sf_dir).select("frame", "ord", d.alias("d"), g["x1"].alias("grown_x1"), g["y1"].alias("grown_y1"), geo.in_band(b, 1280, 720).alias("in_band"))
    return out.select("frame", "ord", "d.*", "grown_x1", "grown_y1", "in_band")


@query(
    "b07_priority",
    f"""WITH {BOXES_SQL} SELECT frame, ord, score / 10.0 + CASE WHEN ord % 3 = 0 THEN 1.0 ELSE 0.0 END + CASE WHEN score / 10.0 >= 0.3 THEN 0.35 ELSE 0.0 END
      + least(0.25, greatest(0, x2 - x1) * greatest(0, y2 - y1) / 50000.0) AS priority FROM bx""",
)
def b07_priority(spark, sf_dir):
    p = geo.priority(F.col("score") / 10.0, F.col("ord") % 3 == 0, Box().area())
    return boxes(spark, sf_dir).select("frame", "ord", p.alias("priority"))


@query(
    "b14_b26_envelope",
    f"""WITH {BOXES_SQL}, c AS (SELECT frame, ord, least(x1, y1 * 2) AS ax, least(y1, x2 // 2) AS ay, greatest(x1, y1 * 2) AS bx2, greatest(y1, x2 // 2) AS by2 FROM bx)
    SELECT frame, ord, greatest(0, least(1279, ax)) AS x1, greatest(0, least(719, ay + 30)) AS y1, greatest(0, least(1280, bx2)) AS x2, greatest(0, least(720, by2 + 30)) AS y2 FROM c
    WHERE greatest(0, least(1280, bx2)) - greatest(0, least(1279, ax)) >= 4 AND greatest(0, least(720, by2 + 30)) - greatest(0, least(719, ay + 30)) >= 4""",
)
def b14_b26_envelope(spark, sf_dir):
    b = boxes(spark, sf_dir)
    points = F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct((F.col("y1") * 2).alias("x"), F.expr("cast(x2 div 2 as int)").alias("y")))
    e = b.select("frame", "ord", geo.envelope(points).alias("e"))
    c = tf.clamp_box(F.col("e.x1"), F.col("e.y1") + 30, F.col("e.x2"), F.col("e.y2") + 30, 1280, 720)
    return e.select("frame", "ord", c.alias("c")).where("c is not null").select("frame", "ord", "c.*")


@query(
    "b22_b23_crops",
    f"""WITH {BOXES_SQL}, u AS (SELECT frame, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM bx GROUP BY frame),
    c AS (SELECT *, greatest(0, y1 - 24) AS a, least(720, y2 + 24) AS b, 363 AS h FROM u),
    d AS (SELECT *, CASE WHEN b - a < h THEN greatest(0, (a + b) // 2 - h // 2) ELSE a END AS a1 FROM c),
    e AS (SELECT *, CASE WHEN b - a < h THEN least(720, a1 + h) ELSE b END AS b1 FROM d)
    SELECT frame, greatest(0, x1 - 16) AS zoom_x1, greatest(0, y1 - 16) AS zoom_y1, least(1280, x2 + 16) AS zoom_x2, least(720, y2 + 16) AS zoom_y2,
      CASE WHEN b - a < h THEN greatest(0, b1 - h) ELSE a1 END AS crop_y1, b1 AS crop_y2 FROM e""",
)
def b22_b23_crops(spark, sf_dir):
    from lapwing.operators.rectangles import crop_bounds, zoom_crop

    return crop_bounds(zoom_crop(boxes(spark, sf_dir), ["frame"], 16, 1280, 720), 24, 1280, 720).select(
        "frame", "zoom_x1", "zoom_y1", "zoom_x2", "zoom_y2", "crop_y1", "crop_y2"
    )


@query("b04_dedupe_rects")
def b04_dedupe_rects(spark, sf_dir):
    from lapwing.operators.rectangles import dedupe_rects

    return dedupe_rects(boxes(spark, sf_dir), ["frame"], 0.65).select("frame", "x1", "y1", "x2", "y2")


@query("b05_dedupe_detections")
def b05_dedupe_detections(spark, sf_dir):
    from lapwing.operators.rectangles import suppress

    return suppress(boxes(spark, sf_dir), ["frame"], F.col("score").cast("double"), 0.55).select("frame", "ord", "score")


@query("b06_dedupe_with_priority")
def b06_dedupe_with_priority(spark, sf_dir):
    from lapwing.operators.rectangles import suppress

    p = geo.priority(F.col("score") / 10.0, F.col("ord") % 3 == 0, Box().area())
    return suppress(boxes(spark, sf_dir), ["frame"], p, 0.55).select("frame", "ord", "score")


_META = "1280, 720"


@query(
    "f03_f04_span_reasons",
    f"""WITH {BOXES_SQL}, d AS (SELECT *, x2 - x1 AS w, y2 - y1 AS h, (x1 + x2) / 2.0 / 1280 AS cx, (y1 + y2) / 2.0 / 720 AS cy FROM bx)
    SELECT frame, ord, CASE WHEN score < 3 THEN 'samples_lt_3' WHEN NOT cy BETWEEN 0.55 AND 0.90 THEN 'center_y_out_sub_band' WHEN NOT cx BETWEEN 0.15 AND 0.85 THEN 'center_x_out_sub_band'
        WHEN h > 120 THEN 'height_gt_120' WHEN h > w THEN 'height_gt_width' WHEN w * h > 1280 * 320 * 0.20 THEN 'area_gt_maxpct_band' ELSE '' END AS span_reason,
      CASE WHEN NOT (cy BETWEEN 0.55 AND 0.90 AND cx BETWEEN 0.15 AND 0.85) THEN 'center_out_sub_band' WHEN h < 25.0 * 720 / 1024.0 THEN 'height_lt_sub_min'
        WHEN h > 100.0 * 720 / 1024.0 THEN 'height_gt_sub_max' WHEN w / greatest(1.0, CAST(h AS DOUBLE)) < 1.2 THEN 'aspect_lt_sub_min' ELSE '' END AS box_reason FROM d""",
)
def f03_f04_span_reasons(spark, sf_dir):
    from lapwing.operators.filters import box_reason, span_reason

    b = boxes(spark, sf_dir)
    return b.select("frame", "ord", span_reason(Box(), F.col("score"), 1280, 720, 400).alias("span_reason"), box_reason(Box(), 1280, 720).alias("box_reason"))


@query(
    "f06_watermark_split",
    f"""WITH {BOXES_SQL} SELECT frame, ord, CASE WHEN (x1 + x2) / 2.0 / 1280 BETWEEN 0.15 AND 0.85 AND (y1 + y2) / 2.0 / 720 BETWEEN 0.55 AND 0.90 THEN 'subtitle'
      WHEN score * 10 >= 80 * 0.8 THEN 'watermark' ELSE 'subtitle' END AS kind FROM bx""",
)
def f06_watermark_split(spark, sf_dir):
    from lapwing.operators.filters import watermark_kind

    return boxes(spark, sf_dir).select("frame", "ord", watermark_kind(Box(), F.col("score") * 10, F.lit(80), 1280, 720).alias("kind"))
