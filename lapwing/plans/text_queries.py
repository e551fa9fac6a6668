"""Text, similarity, hashing and nested queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lapwing.datasets import DIALOGUE_SQL, dialogue, table
from lapwing.functions import hashing as hs
from lapwing.functions import nested as ns
from lapwing.functions import text as tx
from lapwing.functions import timefmt as tf
from lapwing.registry import query


def _turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations")


def _neighbours(spark, sf_dir):
    """Each turn beside the one before it in its conversation."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = _turns(spark, sf_dir).select("conv_id", "turn", "text", F.lag("text").over(w).alias("before"))
    return rows.where("before is not null")


_TURNS = "SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations"


#: Folding of Latin texts; the rules' own compatibility forms are beyond SQL.
_FOLDED = "(SELECT conv_id, turn, text, replace(lower(text), 'ß', 'ss') AS f FROM conversations)"


@query(
    "x01_fold_text",
    rf"""SELECT conv_id, turn, regexp_replace(strip_accents(f), '[^\p{{L}}\p{{N}}_]+', '', 'g') AS folded,
    len(list_filter(regexp_split_to_array(strip_accents(f), '[^\p{{L}}\p{{N}}_]+'), lambda w: length(w) > 1 AND w NOT IN ({", ".join(repr(w) for w in sorted(tx.STOPWORDS))}))) AS n_words FROM {_FOLDED}""",
)
def x01_fold_text(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", "turn", tx.fold_text("text").alias("folded"), F.size(tx.fold_words("text")).alias("n_words"))


@query(
    "x16_x17_keys",
    rf"""SELECT conv_id, turn, regexp_replace(f, '[^\p{{L}}\p{{N}}]+', '', 'g') AS detection, regexp_replace(regexp_replace(f, '\s+', '', 'g'), '^\p{{P}}+|\p{{P}}+$', '', 'g') AS cue FROM {_FOLDED}""",
)
def x16_x17_keys(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", "turn", tx.detection_text("text").alias("detection"), tx.cue_text("text").alias("cue"))


@query("x22_x23_nfc", "SELECT conv_id, turn, text <> '' AND nfc_normalize(text) = text AS is_nfc, nfc_normalize(text) = text AS pair_equal FROM conversations")
def x22_x23_nfc(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", "turn", tx.is_nfc("text").alias("is_nfc"), (tx.nfc("text") == F.col("text")).alias("pair_equal"))


@query("x24_x26_text_size")
def x24_x26_text_size(spark, sf_dir):
    """Width in units, a font size that fits the frame, and the size it takes."""
    lines = F.explode_outer(tx.balanced_lines(F.col("text")))
    rows = _turns(spark, sf_dir).select("conv_id", "turn", lines.alias("line"))
    rows = rows.withColumn("units", tx.units("line")).groupBy("conv_id", "turn").agg(F.max("units").alias("units"), F.count(F.lit(1)).alias("lines"))
    room, base, least = int(1280 * 0.88) - 2 * 3, 29, 22
    fitted = F.floor(F.lit(room) / F.greatest(F.lit(0.1), "units"))
    size = F.when(fitted < least, F.greatest(F.lit(18), F.least(F.lit(base), fitted))).otherwise(F.greatest(F.lit(least), F.least(F.lit(base), fitted)))
    rows = rows.withColumn("font_size", size)
    return rows.withColumns({"width": F.ceil(F.col("units") * F.col("font_size")), "height": F.ceil(F.col("lines") * F.col("font_size") * 1.18)})


@query(
    "x03_tidy_text",
    r"""SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(trim(text), '\b[Tt][Hh][Ee]\s+[Ii][Nn]\b', 'the IN', 'g'), '\s+([,.!?;:])', '\1', 'g'), '[ \t]{2,}', ' ', 'g')) AS tidy
    FROM documents WHERE lang = 'en'""",
)
def x03_tidy_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("lang = 'en'")
    return d.select("doc_id", F.sha2(tx.tidy_punctuation(tx.rename(F.trim("text"), {"the in": "the IN"})), 256).alias("tidy"))


@query("x03_normal_text")
def x03_normal_text(spark, sf_dir):
    """Every document, with the six name replacements."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(tx.normal_text(F.col("text")), 256).alias("tidy"))


@query(
    "x05_phrases",
    """SELECT conv_id, turn, unnest(list_filter(list_transform(string_split_regex(trim(regexp_replace(text, '\\s+', ' ', 'g')), '[,，、;；:：.!。！？?…]+'), lambda p: trim(p)), lambda p: p <> '')) AS phrase FROM conversations""",
)
def x05_phrases(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", "turn", F.explode(tx.phrases(F.col("text"))).alias("phrase"))


_BREAKS = """WITH t AS (SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM conversations), w AS (SELECT *, string_split(t, ' ') AS w FROM t),
    c AS (SELECT conv_id, turn, i, array_to_string(w[1:i], ' ') AS l, array_to_string(w[i + 1:len(w)], ' ') AS r FROM (SELECT *, unnest(range(1, len(w))) AS i FROM w)),
    b AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY {rank}) AS n FROM c)
    SELECT t.conv_id, t.turn, {out} FROM t LEFT JOIN (SELECT * FROM b WHERE n = 1) b ON b.conv_id = t.conv_id AND b.turn = t.turn"""


@query("x06_two_lines", _BREAKS.format(rank="abs(length(l) - length(r)), i", out="CASE WHEN length(t) <= 38 OR l IS NULL THEN t ELSE l || '\\N' || r END AS lines"))
def x06_two_lines(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", "turn", F.array_join(tx.two_lines(F.col("text")), "\\N").alias("lines"))


@query(
    "x07_x08_balanced_lines",
    _BREAKS.format(
        rank="greatest(0, length(l) - 24) + greatest(0, length(r) - 24), abs(length(l) - length(r)), l, r",
        out="CASE WHEN length(t) <= 24 OR l IS NULL THEN t ELSE l || '|' || r END AS lines, CASE WHEN length(t) <= 24 OR l IS NULL THEN 1 ELSE 2 END AS line_count",
    ),
)
def x07_x08_balanced_lines(spark, sf_dir):
    lines = tx.balanced_lines(F.col("text"))
    return _turns(spark, sf_dir).select("conv_id", "turn", F.array_join(lines, "|").alias("lines"), F.size(lines).alias("line_count"))


@query(
    "x09_ass_escape",
    r"""SELECT page_id, sha256(replace(replace(replace(replace(html, '{', '\{'), '}', '\}'), chr(13), ' '), chr(10), '\N')) AS escaped FROM pages""",
)
def x09_ass_escape(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(tx.ass_escape(F.col("html")), 256).alias("escaped"))


@query(
    "x10_title",
    r"""WITH t AS (SELECT conv_id, turn, trim(trim(regexp_replace(text, '\s+', ' ', 'g')), ' .,:;|-') AS t FROM conversations),
    h AS (SELECT *, left(t, 61) AS head FROM t), c AS (SELECT *, rtrim(CASE WHEN contains(head, ' ') THEN regexp_extract(head, '(?s)^(.*) ', 1) ELSE head END, ' .,:;|-') AS cut FROM h)
    SELECT conv_id, turn, CASE WHEN length(t) <= 60 THEN t WHEN cut <> '' THEN cut ELSE rtrim(left(t, 60), ' .,:;|-') END AS title FROM c""",
)
def x10_title(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", "turn", tx.title(F.col("text")).alias("title"))


@query("x12_x13_first_tags")
def x12_x13_first_tags(spark, sf_dir):
    words = F.split(tx.squeeze(F.col("text")), " ")
    return _turns(spark, sf_dir).select("conv_id", "turn", F.array_join(tx.first_distinct(words, 6), " ").alias("tags"))


@query(
    "x14_x15_fields",
    """SELECT conv_id, turn, left(text, 100) AS title, left(concat_ws(chr(10) || chr(10), nullif(text, ''), role, 'part ' || CAST(turn AS VARCHAR)), 5000) AS description,
      rtrim(left(text, 100 - length(' - part ' || CAST(turn AS VARCHAR)))) || ' - part ' || CAST(turn AS VARCHAR) AS series_title FROM conversations""",
)
def x14_x15_fields(spark, sf_dir):
    suffix = F.concat(F.lit(" - part "), F.col("turn").cast("string"))
    description = F.concat_ws("\n\n", F.nullif("text", F.lit("")), "role", F.concat(F.lit("part "), F.col("turn").cast("string")))
    cut = F.rtrim(F.substr("text", F.lit(1), 100 - F.length(suffix)))
    return _turns(spark, sf_dir).select("conv_id", "turn", F.substring("text", 1, 100).alias("title"), F.substring(description, 1, 5000).alias("description"), F.concat(cut, suffix).alias("series_title"))


@query("x18_x20_script", "SELECT doc_id, regexp_replace(text, '[^㐀-鿿]', '', 'g') AS cjk, regexp_matches(text, '[㐀-鿿]') AS has_cjk FROM documents")
def x18_x20_script(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.cjk_only(F.col("text")).alias("cjk"), tx.has_cjk(F.col("text")).alias("has_cjk"))


@query(
    "x21_timeline_prompt",
    f"""WITH {DIALOGUE_SQL} SELECT conv_id, string_agg('[' || printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) || ' - ' || printf('%02d:%02d:%02d', e // 3600, e % 3600 // 60, e % 60) || '] ' || trim(text), chr(10) ORDER BY ord) AS prompt
    FROM dl WHERE trim(text) <> '' GROUP BY conv_id""",
)
def x21_timeline_prompt(spark, sf_dir):
    line = F.concat(F.lit("["), tf.hms(F.col("start")), F.lit(" - "), tf.hms(F.col("end")), F.lit("] "), F.trim("text"))
    rows = dialogue(spark, sf_dir).where("trim(text) <> ''").withColumn("line", line)
    ordered = F.array_sort(F.collect_list(F.struct("ord", "line")))
    return rows.groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("prompt"))


@query(
    "k03_srt",
    f"""WITH {DIALOGUE_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY ord) AS i FROM dl WHERE e > s AND trim(text) <> '')
    SELECT conv_id, count(*) AS cues, string_agg(CAST(i AS VARCHAR) || chr(10) || printf('%02d:%02d:%02d,%03d', s // 3600000, s % 3600000 // 60000, s % 60000 // 1000, s % 1000) || ' --> '
      || printf('%02d:%02d:%02d,%03d', e // 3600000, e % 3600000 // 60000, e % 60000 // 1000, e % 1000) || chr(10) || trim(text), chr(10) || chr(10) ORDER BY i) AS srt FROM n GROUP BY conv_id""",
)
def k03_srt(spark, sf_dir):
    from lapwing.sources.sinks import srt_documents

    return srt_documents(dialogue(spark, sf_dir), ["conv_id"])


# --- similarity ------------------------------------------------------------


@query(
    "m01_same_or_contained",
    f"WITH t AS ({_TURNS}) SELECT conv_id, turn, text = before OR (least(length(text), length(before)) >= 6 AND CASE WHEN length(before) <= length(text) THEN contains(text, before) ELSE contains(before, text) END) AS same FROM t WHERE before IS NOT NULL",
)
def m01_same_or_contained(spark, sf_dir):
    return _neighbours(spark, sf_dir).select("conv_id", "turn", tx.same_or_contained(F.col("before"), F.col("text")).alias("same"))


@query(
    "m03_token_subset",
    f"""WITH t AS ({_TURNS}), w AS (SELECT conv_id, turn, list_distinct(string_split(lower(text), ' ')) AS a, list_distinct(string_split(lower(before), ' ')) AS b FROM t WHERE before IS NOT NULL),
    c AS (SELECT conv_id, turn, len(list_intersect(a, b)) AS common, least(len(a), len(b)) AS small FROM w)
    SELECT conv_id, turn, small >= 3 AND common >= 3 AND common >= small * 0.75 AS subset FROM c""",
)
def m03_token_subset(spark, sf_dir):
    w = lambda c: F.split(F.lower(c), " ")
    return _neighbours(spark, sf_dir).select("conv_id", "turn", tx.token_subset(w("before"), w("text")).alias("subset"))


@query("m02_m07_similarity")
def m02_m07_similarity(spark, sf_dir):
    return _neighbours(spark, sf_dir).select(
        "conv_id", "turn", tx.similar_text("before", "text").alias("similar"), tx.text_similarity("before", "text").alias("similarity"),
        tx.script_similarity("before", "text").alias("script"), tx.ocr_alike("before", "text").alias("ocr"), tx.block_ratio("before", "text").alias("ratio"),
    )


@query("m04_m08_duplicate_lines")
def m04_m08_duplicate_lines(spark, sf_dir):
    """The dialogue duplicate rule between neighbours, and which one survives."""
    from lapwing.operators import folds

    return folds.neighbour_duplicates(dialogue(spark, sf_dir).withColumn("text_zh", F.lit("")), ["conv_id"])


# --- keys and digests ------------------------------------------------------

_NORM = """regexp_replace(lower(regexp_extract(trim(url), '^([A-Za-z][A-Za-z0-9+.-]*):', 1)), '^$', 'https') || '://' || lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))
    || CASE WHEN trim(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') = '' THEN '/' ELSE '/' || trim(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') || '/' END"""


@query(
    "h01_h05_url_keys",
    f"""WITH n AS (SELECT page_id, url, {_NORM} AS norm FROM pages)
    SELECT page_id, norm, left(sha256(norm || chr(10) || 'long'), 32) AS cache_key, left(sha256(norm), 32) AS raw_key, 'source-' || left(sha256(norm), 12) AS source_id FROM n""",
)
def h01_h05_url_keys(spark, sf_dir):
    n = table(spark, sf_dir, "pages").select("page_id", hs.normalize_url(F.col("url")).alias("norm"))
    return n.select(
        "page_id", "norm", hs.cache_key(F.col("norm"), F.lit("long")).alias("cache_key"), F.substring(F.sha2("norm", 256), 1, 32).alias("raw_key"), hs.source_id(F.col("norm")).alias("source_id")
    )


@query(
    "h04_f13_strict_url",
    r"""WITH r AS (SELECT page_id, rtrim(trim(url), '.,;!?)]}') AS raw FROM pages),
    h AS (SELECT page_id, regexp_replace(lower(regexp_extract(raw, '(?i)^https?://([^/?#:]*)', 1)), '^www[.]', '') AS host, regexp_replace(regexp_extract(raw, '(?i)^https?://[^/?#]*([^?#]*)', 1), '/{2,}', '/', 'g') AS path FROM r)
    SELECT page_id, CASE WHEN regexp_matches(host, '^(.*[.])?(example[.]com|example[.]org)$') THEN 'https://' || host || rtrim(CASE WHEN path = '' THEN '/' ELSE path END, '/') || '/' END AS url FROM h""",
)
def h04_f13_strict_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", hs.strict_url(F.col("url"), ["example.com", "example.org"]).alias("url"))


@query(
    "h06_h15_object_ids",
    """WITH x AS (SELECT page_id, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '(.)[.][^.]*$', '\\1') AS stem, url FROM pages),
    s AS (SELECT *, CASE WHEN trim(regexp_replace(stem, '[^0-9A-Za-z._-]+', '-', 'g'), '-._') = '' THEN 'item' ELSE trim(regexp_replace(stem, '[^0-9A-Za-z._-]+', '-', 'g'), '-._') END AS slug FROM x)
    SELECT page_id, left(slug, 80) || '-' || left(sha256('bucket/' || url || '#' || CAST(page_id AS VARCHAR)), 12) AS object_id, 'gs://r/v-1/source-' || left(sha256(url), 12) || '/status.json' AS status_uri FROM s""",
)
def h06_h15_object_ids(spark, sf_dir):
    oid = hs.object_id(F.lit("bucket"), F.col("url"), F.col("page_id").cast("string"))
    status = hs.artifact(F.lit("gs://r/"), F.lit(" v 1!"), hs.source_id(F.col("url")), "status.json")
    return table(spark, sf_dir, "pages").select("page_id", oid.alias("object_id"), status.alias("status_uri"))


@query(
    "h07_state_key",
    """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN left(sha1(trim(url)), 16) ELSE 'key_' || CAST(page_id AS VARCHAR) END AS state_key FROM pages""",
)
def h07_state_key(spark, sf_dir):
    key = F.when(F.col("page_id") % 3 != 0, F.concat(F.lit(" key/_"), F.col("page_id").cast("string")))
    return table(spark, sf_dir, "pages").select("page_id", hs.state_key(F.col("url"), key).alias("state_key"))


@query("h08_signature")
def h08_signature(spark, sf_dir):
    sign = hs.signature(b"test-only")
    return table(spark, sf_dir, "pages").select("page_id", sign("url", (F.col("page_id") + 1000).cast("long")).alias("signature"))


@query("h09_h13_canonical_json", "SELECT event_id, sha256(replace(props, ' ', '')) AS root, true AS same FROM events")
def h09_h13_canonical_json(spark, sf_dir):
    c = table(spark, sf_dir, "events").select("event_id", "props", hs.canonical("props").alias("canonical"))
    return c.select("event_id", F.sha2("canonical", 256).alias("root"), hs.same_document("props", "canonical").alias("same"))


@query("h11_bytes_equal", "SELECT doc_id, sha256(text) AS digest, strlen(text) AS size FROM documents")
def h11_bytes_equal(spark, sf_dir):
    raw = F.col("text").cast("binary")
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(raw, 256).alias("digest"), F.octet_length(raw).cast("long").alias("size"))


# --- nested ----------------------------------------------------------------


@query("n01_json_items")
def n01_json_items(spark, sf_dir):
    d = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit('{"list":[{"aid":"'), F.col("event_id").cast("string"), F.lit('","p":'), "props", F.lit("},{\"aid\":\"x\"}]}")).alias("doc"))
    return d.lateralJoin(ns.JsonItems(F.col("doc").outer(), F.lit("aid"))).select("event_id", "id", "item")


@query("n02_n03_json_nodes")
def n02_n03_json_nodes(spark, sf_dir):
    d = table(spark, sf_dir, "events").where("event_id % 1 = 0").select("event_id", "props")
    nodes = d.lateralJoin(ns.JsonNodes(F.col("props").outer()))
    return nodes.groupBy("event_id").agg(F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("kind") == "str").alias("strings"), F.max(F.length("path")).alias("deepest"))


@query("n09_first_url", """SELECT page_id, rtrim(regexp_extract(html, '(https?://[^\\s"''<>]+)', 1), '.,);') AS first_url FROM pages""")
def n09_first_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", ns.first_url(F.col("html")).alias("first_url"))


@query(
    "n04_n06_typed_props",
    """WITH k AS (SELECT event_id, props, unnest(json_keys(props)) AS field FROM events), v AS (SELECT event_id, field, json_extract_string(props, '$."' || field || '"') AS value FROM k)
    SELECT event_id, field, coalesce(value, '') AS value, coalesce(TRY_CAST(value AS DOUBLE), 0.0) AS number FROM v""",
)
def n04_n06_typed_props(spark, sf_dir):
    """Props as a map and as typed fields with defaults."""
    m = F.from_json("props", "map<string,string>")
    rows = table(spark, sf_dir, "events").select("event_id", F.explode(m).alias("field", "value"))
    return rows.select("event_id", "field", F.coalesce("value", F.lit("")).alias("value"), F.coalesce(F.col("value").try_cast("double"), F.lit(0.0)).alias("number"))


@query("n10_detector_rows")
def n10_detector_rows(spark, sf_dir):
    leaf = F.concat(F.lit("[[[[0,0],[4,0],[4,2],[0,2]],[\"t"), F.col("event_id").cast("string"), F.lit('",0.5]],[[{"boxes":[[[1,1],[2,2]]],"texts":["u"],"scores":[0.25]}]]]'))
    d = table(spark, sf_dir, "events").select("event_id", leaf.alias("doc"))
    return d.lateralJoin(ns.DetectorRows(F.col("doc").outer())).select("event_id", F.array_join(F.col("detector_box").cast("array<string>"), ",").alias("box"), "text", "score")
