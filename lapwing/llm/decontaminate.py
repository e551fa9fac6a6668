"""Benchmark decontamination against a broadcast hash set of n-grams (native).

Each benchmark item gives windows of ``n`` consecutive normalised words (an item
shorter than that is one window).  The windows' 64-bit hashes form the set; the
hashes of every document window are built from pairwise hashes of power-of-two
lengths, so a window of ten words costs four hash steps per position, not ten.
Document windows are exploded and probe the set inside one generated stage.
Each probe that meets the set is verified word by word, so a hash collision
never counts.  The set holds a window's hash and words, of bounded size, and not whose
it is: that is looked up for the windows that were met.

The set is broadcast only while it has at most ``broadcast_windows`` distinct
windows; a larger benchmark is split by hash into blocks of that bound and every
block scans the documents in turn, so memory stays bounded and results whole.

Defined results: null and empty texts have no words and no hits; items without
words give no window; items that share an id are one, and items without an id count
as one more that is not in the list; null document ids are kept; repeated document
rows give repeated results; empty tables give empty results or no hits; extra
columns pass through :func:`decontaminate`, whatever they are called.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwing.llm._common import materialize, parted, read_table, slot, text_or_empty

WINDOW = 10
BROADCAST_WINDOWS = 400_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word before lowering: as in the contract, with A-Z.
_RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, ASCII letters (lower-cased) and non-ASCII characters.

    The pattern takes upper case too and only the words are lowered, A-Z alone.
    """
    found = F.regexp_extract_all(text_or_empty(text), F.lit(_RAW_WORD), 0)
    return F.transform(found, lower_ascii)


def lower_ascii(word: Column) -> Column:
    """A-Z lowered, all else untouched."""
    low = F.lower(word)
    return F.when(low == word, word).when(F.octet_length(word) == F.length(word), low).otherwise(F.translate(word, _UPPER, _LOWER))


def _with_window_hashes(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """From ``wh`` (one hash a word) the columns ``h<n>``: hashes of the ``n``
    words from each position on.  Hashes of 2, 4, 8 words are columns of their
    own, so each is computed once."""

    def joined(left: str, right: str, shift: int) -> Column:
        tail = F.slice(right, F.lit(shift + 1), F.greatest(F.size(right) - shift, F.lit(0)))
        return F.zip_with(left, tail, lambda a, b: F.xxhash64(a, b))

    width = 1
    rows = rows.withColumn("p1", F.col("wh"))
    while width * 2 <= max(lengths, default=1):
        rows = rows.withColumn(f"p{width * 2}", joined(f"p{width}", f"p{width}", width))
        width *= 2
    for n in lengths:
        done, total = None, 0
        for bit in (1, 2, 4, 8, 16, 32, 64, 128):
            if n & bit:
                if done is None:
                    rows, done = rows.withColumn(f"q{n}", F.col(f"p{bit}")), f"q{n}"
                else:
                    rows = rows.withColumn(done, joined(done, f"p{bit}", total))
                total += bit
        rows = rows.withColumn(f"h{n}", F.slice(done, F.lit(1), F.greatest(F.size("wh") - (n - 1), F.lit(0))))
    return rows


def windows_of(benchmark: DataFrame, text_col: str, id_col: str, window: int) -> DataFrame:
    """``n, gram, item``: each benchmark item's distinct windows."""
    w = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("n", F.least(F.size("w"), F.lit(window)))
    grams = w.select(
        "item", "n", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1), lambda i: F.slice("w", i, F.col("n")))).alias("gram")
    )
    return grams.distinct()


def _hashed(grams: DataFrame, lengths: list[int]) -> DataFrame:
    rows = _with_window_hashes(grams.withColumn("wh", F.transform("gram", lambda x: F.xxhash64(x))), lengths)
    h = F.coalesce(*[F.when(F.col("n") == n, F.element_at(f"h{n}", 1)) for n in lengths])
    return rows.select("n", h.alias("h"), "gram")


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    item_text_col: str = "text",
    item_id_col: str = "item_id",
    window: int = WINDOW,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, text_hash, n_words, n_hit, items, unnamed, spans``.

    ``spans`` are merged word ranges ``(start, end)`` (0-based, end exclusive).
    Rows that agree in id and text hash to the same result and come once, with
    ``copies`` telling how many there were.  ``unnamed``: an item without an id is
    among those found.
    """
    owners = materialize(windows_of(benchmark, item_text_col, item_id_col, window), "owners")
    grams = materialize(owners.select("n", "gram").distinct(), "windows")
    shape = grams.groupBy("n").count().orderBy("n").collect()  # at most ``window`` rows
    lengths, size = [r["n"] for r in shape], sum(r["count"] for r in shape)
    blocks = max(1, -(-size // broadcast_windows))
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text_or_empty(F.col(text_col)), F.lit(7)).alias("text_hash"),
        words(F.col(text_col)).alias("w"),
    ).withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))
    marker = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("at"), F.lit(0).cast("bigint").alias("h"))

    base = _with_window_hashes(base, lengths)

    def per_length(n: int) -> Column:
        return F.transform(f"h{n}", lambda h, i: F.struct(F.lit(n).alias("n"), i.alias("at"), h.alias("h")))

    found = []
    hashed = _hashed(grams, lengths) if lengths else None
    for b in range(blocks):
        # One row per document is kept by the marker: position -1 always matches.
        probes = F.concat(F.array(marker), *[per_length(n) for n in lengths]) if lengths else F.array(marker)
        rows = base.select("doc_id", "text_hash", "w", probes.alias("probes"))
        # explode_outer: plain explode lets the optimizer infer a filter on the array's
        # size, pushed to the scan with every hash step inlined.  No array is empty.
        rows = rows.select("doc_id", "text_hash", "w", F.explode_outer("probes").alias("p"))
        rows = rows.select("doc_id", "text_hash", "w", F.col("p.n").alias("n"), F.col("p.at").alias("at"), F.col("p.h").alias("h"))
        always = docs.sparkSession.range(1).select(
            F.lit(0).alias("known_n"), F.lit(0).cast("bigint").alias("h"), F.array().cast("array<string>").alias("gram")
        )
        known = always
        if hashed is not None:
            mine = hashed.where(F.pmod("h", F.lit(blocks)) == b) if blocks > 1 else hashed
            known = always.unionByName(mine.select(F.col("n").alias("known_n"), "h", "gram"))
        verified = F.when(F.col("at") < 0, F.col("known_n") == 0).otherwise(
            (F.col("known_n") == F.col("n")) & (F.slice("w", F.greatest(F.col("at"), F.lit(0)) + 1, F.col("n")) == F.col("gram"))
        )
        met = rows.join(F.broadcast(known), "h").where(verified)
        found.append(met.select("doc_id", "text_hash", F.when(F.col("at") < 0, F.size("w")).alias("n_words"), "at", "n", F.when(F.col("at") >= 0, F.col("gram")).alias("gram")))
    met = materialize(reduce(DataFrame.unionByName, found), "hits")
    key = ["doc_id", "text_hash"]
    # Several blocks give a document several markers: n_words is their common
    # value, and the copies are counted on the markers of one block.
    words_ = met.where("at < 0").groupBy(*key).agg(F.max("n_words").cast("long").alias("n_words"), (F.count(F.lit(1)) / blocks).cast("long").alias("copies"))
    # A span begins where a hit starts beyond every end before it.
    hit = met.where("at >= 0").select(*key, F.col("at").alias("start"), (F.col("at") + F.col("n")).alias("end")).distinct()
    ordered = Window.partitionBy(*key).orderBy("start", "end")
    ended = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    hit = hit.withColumn("first", ended.isNull() | (F.col("start") > ended)).withColumn("span", F.count_if("first").over(ordered))
    spans = hit.groupBy(*key, "span").agg(F.min("start").alias("start"), F.max("end").alias("end")).select(*key, F.struct("start", "end").alias("span"))
    # Whose the windows are is asked only for those that were met: a window of many
    # items is neither broadcast nor held with every hit.
    seen = met.where("at >= 0").select(*key, "n", "gram").distinct()
    items = seen.join(owners, ["n", "gram"]).select(*key, "item", F.lit(True).alias("owned")).distinct()
    every = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [words_, spans, items])
    return (
        every.groupBy(*key)
        .agg(
            F.max("n_words").alias("n_words"),
            F.max("copies").alias("copies"),
            F.sort_array(F.collect_set("item")).alias("items"),
            F.coalesce(F.max(F.col("owned") & F.col("item").isNull()), F.lit(False)).alias("unnamed"),
            F.sort_array(F.collect_list("span")).alias("spans"),
        )
        .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"]))
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    min_share: float = 0.0,
    min_hit: int = 1,
    remove: str = "documents",
    **options,
) -> DataFrame:
    """``docs`` without what is contaminated, all columns kept.

    ``remove="documents"`` drops each document with at least ``min_hit`` hit
    words that make at least ``min_share`` of its words.  ``remove="spans"``
    keeps every document and cuts the hit word ranges out of its text: the words
    of the ranges and what stands between them go, the rest stays as written.
    """
    found = hits(docs, benchmark, text_col, id_col, **options)
    bad = found.where((F.col("n_hit") >= min_hit) & (F.col("n_hit") >= F.col("n_words") * F.lit(min_share)) & (F.col("n_hit") > 0))
    bad = materialize(bad.select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash"), F.col("spans").alias("_bad_spans"), slot(F.col("text_hash")).alias("_slot")), "contaminated")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("_id"),
        F.xxhash64(text_or_empty(F.col(text_col)), F.lit(7)).alias("_hash"),
    )
    sure, unsure = parted(rows.withColumn("_slot", slot(F.col("_hash"))), bad)
    bad = bad.drop("_slot")
    on = F.col("_id").eqNullSafe(F.col("_bad_id")) & (F.col("_hash") == F.col("_bad_hash"))
    sure = sure.select("row.*")
    if remove == "documents":
        return sure.union(unsure.join(bad, on, "left_anti").select("row.*"))
    text = F.col(f"row.`{text_col}`")
    gaps = F.split(text, _RAW_WORD, -1)
    plain = F.regexp_extract_all(text, F.lit(_RAW_WORD), 0)
    pieces = F.concat(F.zip_with(F.slice(gaps, F.lit(1), F.size(plain)), plain, lambda g, w: F.struct(g.alias("g"), w.alias("w"))), F.array(F.struct(F.element_at(gaps, -1).alias("g"), F.lit("").alias("w"))))

    def kept(p: Column, i: Column) -> Column:
        in_word = F.exists("_bad_spans", lambda s: (s["start"] <= i) & (i < s["end"]))
        in_gap = F.exists("_bad_spans", lambda s: (s["start"] < i) & (i < s["end"]))
        return F.concat(F.when(in_gap, F.lit("")).otherwise(p["g"]), F.when(in_word, F.lit("")).otherwise(p["w"]))

    cut = F.array_join(F.transform(pieces, kept), "")
    joined = unsure.join(bad, on, "left")
    return sure.union(joined.select(
        *[
            (F.when(F.col("_bad_spans").isNull(), text).otherwise(cut) if c == text_col else F.col(f"row.`{c}`")).alias(c)
            for c in docs.columns
        ]
    ))


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    found = hits(docs.select("doc_id", "text"), items.select("item_id", "text"))
    one_each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return found.withColumn("copy", one_each).select(
        "doc_id",
        "n_words",
        "n_hit",
        (F.size("items") + F.col("unnamed").cast("int")).cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_SQL_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), '" + _UPPER + "', '" + _LOWER + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP4_SQL = f"""
WITH low AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
it AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
itn AS (SELECT item_id, w, least({WINDOW}, len(w)) AS n FROM it WHERE len(w) > 0),
g AS (SELECT DISTINCT n, item_id, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM itn)),
ns AS (SELECT DISTINCT n FROM g),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
       FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM low, ns)),
h AS (SELECT dw.doc_id, dw.i, dw.n, g.item_id FROM dw JOIN g ON g.n = dw.n AND g.gram = dw.gram),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT low.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN hit ON hit.doc_id = low.doc_id LEFT JOIN found ON found.doc_id = low.doc_id
"""
