"""Rules on documents that refer to one another, with planted faults.

The documents are made of the orders: number ``k`` decides by its remainders which
fault a document has, so the SQL says what must be found from ``k`` alone, without
any of the joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapwing.datasets import table
from lapwing.operators import evidence as ev
from lapwing.registry import query

DAY = ev.DAY_SECONDS
DEALT = 20_000  # orders a partition: the documents made of them are sorted in a task's memory
ROLES = ["clean_a", "clean_b", "speech_a", "speech_b"]


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))


def _sha(name: str, *columns):
    """A digest of a name and columns."""
    return F.sha2(F.concat_ws(":", F.lit(name), *columns).cast("binary"), 256)


def _hit(by: int, rest: int, *more):
    """Whether ``k`` leaves ``rest`` when divided by ``by`` (and the rest holds)."""
    out = F.col("k") % by == rest
    for m in more:
        out = out & m
    return out


def _problems(df, *columns):
    return df.select("k", *columns, F.array_join("problems", ",").alias("problems"))


def _sql(columns: str, source: str, *cases: tuple[str, str]) -> str:
    """What is expected: each problem and when it is there, in order."""
    found = ", ".join(f"CASE WHEN {when} THEN '{name}' END" for name, when in cases)
    return f"SELECT {columns}, concat_ws(',', {found}) AS problems FROM {source}"


_K = "(SELECT o_orderkey AS k FROM orders)"


# --- verdicts ------------------------------------------------------------------


@query(
    "v13_v18_verdict_roles",
    _sql("k", _K, ("roles", "k % 13 = 1 OR k % 17 = 2"), ("decision", "k % 19 IN (1, 2, 3) OR k % 19 = 0 AND k % 17 <> 2"), ("verdict.engine", "k % 23 = 4"), ("older", "k % 29 = 5")),
)
def v13_v18_verdict_roles(spark, sf_dir):
    reports = _orders(spark, sf_dir).select("k", (F.col("k") % 101).alias("engine"), (F.col("k") % 7).alias("policy"), (F.col("k") * 10).alias("issued"))
    i = F.col("ord")
    role = F.when(_hit(13, 1, i == 2), ROLES[0]).otherwise(F.get(F.array(*[F.lit(r) for r in ROLES]), i))
    verdicts = reports.select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("ord")).where(~_hit(17, 2, i == 3))
    verdicts = verdicts.select(
        "k", "ord", role.alias("role"), F.when((F.col("k") + i) % 19 == 3, "fail").otherwise("pass").alias("decision"),
        F.when(_hit(23, 4, i == 1), 7777).otherwise(F.col("engine")).alias("engine"), "policy", (F.col("issued") + i - F.when(_hit(29, 5, i == 0), 5).otherwise(0)).alias("issued"),
    )
    return _problems(ev.verdicts_bind(reports, verdicts, ["k"], ROLES, ["engine", "policy"], "issued"))


# --- a chain of approvals ------------------------------------------------------


@query(
    "v14_v28_v29_release_chain",
    _sql(
        "k", _K, ("no_release", "k % 11 = 1"), ("repeated_release", "k % 13 = 2 AND k % 11 <> 1"), ("release.clean", "k % 17 = 3 AND k % 11 <> 1"),
        ("no_index", "k % 31 = 6"), ("index.clean", "k % 29 = 5 AND k % 31 <> 6"), ("index.report", "k % 19 = 4 AND k % 31 <> 6"),
    ),
)
def v14_v28_v29_release_chain(spark, sf_dir):
    clean = _orders(spark, sf_dir).select("k", _sha("clean", "k").alias("clean"), _sha("report", "k").alias("report"))
    release = clean.where(~_hit(11, 1)).select("k", F.when(_hit(17, 3), "x").otherwise(F.col("clean")).alias("clean_sha"))
    release = release.unionByName(release.where(_hit(13, 2)))
    index = clean.where(~_hit(31, 6)).select("k", F.when(_hit(29, 5), "x").otherwise(F.col("clean")).alias("clean_sha"), F.when(_hit(19, 4), "x").otherwise(F.col("report")).alias("report_sha"))
    rows = ev.agree(clean, release, ["k"], {"clean": "clean_sha"}, "release")
    return _problems(ev.agree(rows, index, ["k"], {"clean": "clean_sha", "report": "report_sha"}, "index"))


# --- packets and requests --------------------------------------------------------


@query(
    "j22_v17_packets",
    _sql(
        "k", _K, ("unresolved", "k % 11 = 1 OR k % 13 = 2"), ("repeated", "k % 17 = 3"), ("total", "k % 19 = 4"), ("lifetime", "k % 23 = 5 OR k % 37 = 6"),
        ("kind_report", "k % 29 = 6"), ("kind_ledger", "k % 31 = 7"),
    ),
)
def j22_v17_packets(spark, sf_dir):
    i, size = F.col("ord"), F.col("k") % 1000 + F.col("ord") * 7 + 1
    every = _orders(spark, sf_dir).select("k", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("ord"))
    kind = F.get(F.array(*[F.lit(x) for x in ("report", "ledger", "frame", "frame")]), i)
    name = F.when(_hit(17, 3, i == 3), F.lit(2)).otherwise(i)  # the last one names the third again
    refs = every.select("k", F.when(_hit(29, 6, i == 0) | _hit(31, 7, i == 1), "frame").otherwise(kind).alias("kind"), _sha("object", "k", name.cast("string")).alias("sha256"), F.when(_hit(17, 3, i == 3), size - 7).otherwise(size).alias("bytes"))
    objects = every.where(~_hit(11, 1, i == 0)).select(_sha("object", "k", i.cast("string")).alias("sha256"), (size + F.when(_hit(13, 2, i == 1), 1).otherwise(0)).alias("bytes"))
    total = refs.groupBy("k").agg(F.sum("bytes").alias("declared"))
    life = F.when(_hit(23, 5), 3 * DAY).when(_hit(37, 6), 0).otherwise(2 * DAY)
    rows = total.select("k", (F.col("declared") + F.when(_hit(19, 4), 1).otherwise(0)).alias("declared"), F.lit(1000).alias("created"), (1000 + life).alias("expires"))
    return _problems(ev.packets(rows, refs, objects, ["k"], ["report", "ledger"]))


@query(
    "v10_idempotency",
    _sql(
        "k", _K, ("no_request", "k % 11 = 1"), ("request.request_sha256", "k % 13 = 2 AND k % 11 <> 1"), ("lifetime", "k % 17 = 3"),
        ("conflict", "k % 4 = 0 AND k % 19 IN (4, 5) OR k % 4 <> 0 AND k % 23 = 6"),
    ),
)
def v10_idempotency(spark, sf_dir):
    body = F.concat(F.lit('{"order":'), F.col("k").cast("string"), F.lit("}"))
    requests = _orders(spark, sf_dir).where(~_hit(11, 1)).select("k", body.alias("body"))
    digest = F.sha2(F.when(_hit(13, 2), F.concat(body, F.lit(" "))).otherwise(body).cast("binary"), 256)
    rows = _orders(spark, sf_dir).withColumns({"request_sha256": digest, "outcome": F.when(F.col("k") % 4 == 0, "conflict").when(F.col("k") % 4 == 1, "replay").otherwise("stored")})
    other = F.when(F.col("outcome") == "conflict", F.when(_hit(19, 4), F.lit(None)).when(_hit(19, 5), F.col("request_sha256")).otherwise(_sha("other", "k"))).when(_hit(23, 6), _sha("other", "k"))
    rows = rows.withColumns({"conflict_sha256": other, "created": F.col("k"), "expires": F.col("k") + 7 * DAY + F.when(_hit(17, 3), 1).otherwise(0)})
    return _problems(ev.idempotency(rows, requests, "k"))


# --- translation and speech -------------------------------------------------------

_KI = "(SELECT o_orderkey AS k, unnest(range(3)) AS i FROM orders)"


def _thrice(spark, sf_dir, n: int = 3):
    return _orders(spark, sf_dir).select("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("index"))


@query(
    "v23_candidates",
    _sql(
        'k, i AS "index"', _KI, ("no_source", "k % 11 = 1"), ("source.cue_id", "k % 13 = 2 AND k % 11 <> 1"), ("source.source_sha256", "k % 17 = 3 AND i = 1 AND k % 11 <> 1"),
        ("reason", "k % 19 = 4 AND i <> 1 OR k % 19 = 5 AND i = 0"), ("text", "k % 23 = 6 AND i = 2"), ("order", "k % 29 = 7 AND i = 2"),
    ),
)
def v23_candidates(spark, sf_dir):
    sources = _orders(spark, sf_dir).where(~_hit(11, 1)).select("k", F.concat(F.lit("cue-"), (F.col("k") + F.when(_hit(13, 2), 1).otherwise(0)).cast("string")).alias("cue_id"), _sha("cue", "k").alias("sha256"))
    i = F.col("index")
    reason = F.when(_hit(19, 4), F.when(i < 2, "why")).when(_hit(19, 5), "why").when(i > 0, "too long")
    rows = _thrice(spark, sf_dir).select(
        "k", "index", F.concat(F.lit("cue-"), F.col("k").cast("string")).alias("cue_id"), F.when(_hit(17, 3, i == 1), "x").otherwise(_sha("cue", "k")).alias("source_sha256"), reason.alias("reason"),
        F.lit("é").alias("text_raw"), F.when(_hit(23, 6, i == 2), "é").otherwise("é").alias("text"), (i * 10 - F.when(_hit(29, 7, i == 2), 10).otherwise(0)).alias("created"),
    )
    return _problems(ev.candidates(rows, sources, ["k"]), "index")


@query(
    "v19_v24_preflight",
    _sql(
        "k", _K, ("no_candidate", "k % 11 = 1"), ("candidate.policy", "k % 13 = 2 AND k % 11 <> 1"), ("roles", "k % 17 = 3"), ("decision", "k % 19 = 4"),
        ("verdict.policy", "k % 13 = 2 OR k % 23 = 5"), ("shared_model", "k % 29 = 6"), ("too_long", "k % 31 = 7"), ("early", "k % 37 = 8"),
    ),
)
def v19_v24_preflight(spark, sf_dir):
    approvals = _orders(spark, sf_dir).select("k", _sha("text", "k").alias("candidate"), F.when(_hit(13, 2), -1).otherwise(F.col("k") % 5).alias("policy"), F.lit(100).alias("issued"), (100 + 7 * DAY + F.when(_hit(31, 7), 1).otherwise(0)).alias("expires"))
    candidates = _orders(spark, sf_dir).where(~_hit(11, 1)).select("k", _sha("text", "k").alias("candidate"), (F.col("k") % 5).alias("policy"), F.lit("g").alias("model"), F.lit(10).alias("created"))
    i = F.col("ord")
    verdicts = _orders(spark, sf_dir).select("k", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("ord")).select(
        "k", "ord", F.when(_hit(17, 3), "style").otherwise(F.get(F.array(F.lit("semantic"), F.lit("style")), i)).alias("role"), F.when(_hit(19, 4, i == 1), "fail").otherwise("pass").alias("decision"),
        _sha("text", "k").alias("candidate"), F.when(_hit(23, 5, i == 0), 9).otherwise(F.col("k") % 5).alias("policy"), F.when(_hit(29, 6), "s").otherwise(F.get(F.array(F.lit("s"), F.lit("t")), i)).alias("model"),
        F.when(_hit(37, 8, i == 1), 100).otherwise(50).alias("issued"),
    )
    return _problems(ev.preflight(approvals, candidates, verdicts, ["k"], ["semantic", "style"], ["candidate", "policy"]))


OUTCOMES = {"accepted": (True, True), "too_long": (True, False), "engine_error": (False, False)}


@query(
    "j23_v25_speech_attempts",
    _sql(
        'k, i AS "index"', "(SELECT k, CASE WHEN k % 17 = 3 AND i > 0 THEN i + 1 ELSE i END AS i, i AS p FROM (SELECT o_orderkey AS k, unnest(range(3)) AS i FROM orders))",
        ("not_approved", "k % 11 = 1"), ("index", "k % 17 = 3 AND p > 0"), ("outcome", "k % 19 = 4 AND p = 0"), ("evidence", "k % 23 = 5 AND p = 1"), ("selected", "k % 29 = 6 AND k % 31 <> 7 AND p = 1"), ("retried", "k % 31 = 7 AND p = 1"),
    ),
)
def j23_v25_speech_attempts(spark, sf_dir):
    p = F.col("index")
    approvals = _orders(spark, sf_dir).where(~_hit(11, 1)).select(_sha("text", "k").alias("candidate_sha256"))
    outcome = F.when(_hit(19, 4, p == 0), "lost").when((p == 2) | _hit(31, 7, p == 1), "accepted").when(p == 1, "too_long").otherwise("engine_error")
    rows = _thrice(spark, sf_dir).select(
        "k", p.alias("p"), F.when(_hit(17, 3, p > 0), p + 1).otherwise(p).alias("index"), _sha("text", "k").alias("candidate_sha256"), outcome.alias("outcome"),
        ((p > 0) & ~_hit(23, 5, p == 1)).alias("has_audio"), ((p == 2) | _hit(29, 6, p == 1, ~_hit(31, 7))).alias("selected"),
    )
    return _problems(ev.speech_attempts(rows, approvals, ["k"], OUTCOMES), "index")


@query(
    "j19_cue_ledger",
    _sql(
        'k, i AS "index"', _KI, ("no_cue", "k % 11 = 1 AND i = 2"), ("cue.source_sha256", "k % 13 = 2 AND NOT (k % 11 = 1 AND i = 2)"), ("no_translation", "k % 17 = 3 AND i = 1"),
        ("translation.text", "k % 19 = 4 AND NOT (k % 17 = 3 AND i = 1)"), ("speech.onset", "k % 23 = 5 AND i = 1"), ("empty", "k % 29 = 6 AND i = 2"), ("overlap", "k % 31 = 7 AND i = 1"), ("gap", "k % 37 = 8 AND i > 0"),
    ),
)
def j19_cue_ledger(spark, sf_dir):
    i = F.col("index")
    onset = i * 100 - F.when(_hit(31, 7, i == 1), 50).otherwise(0)
    offset = F.when(_hit(29, 6, i == 2), onset).otherwise(i * 100 + 80)
    # Numbers are dealt before documents are made of them, so that no digest moves.  By
    # the count of rows (Parquet's own): the numbers' bytes say nothing of the documents'.
    partitions = max(2, -(-_orders(spark, sf_dir).count() // DEALT))  # a single one counts as dealt by no key
    every = _thrice(spark, sf_dir).repartition(partitions, "k", "index").withColumns({"onset": onset, "offset": offset, "number": i.cast("string")})
    sha = lambda what: _sha(what, "k", F.col("number"))
    gap = F.when(i > 0, F.col("onset") - ((i - 1) * 100 + 80) - 1 + F.when(_hit(37, 8), 1).otherwise(0))
    entries = every.select(
        "k", "index", sha("cue").alias("cue_id"), sha("src").alias("source_sha256"), sha("tr").alias("translation_sha256"), sha("cand").alias("candidate_sha256"), F.col("number").alias("text"),
        sha("tts").alias("speech_sha256"), "onset", "offset", gap.alias("gap"),
    )
    manifest = every.where(~_hit(11, 1, i == 2)).select("k", "index", sha("cue").alias("cue_id"), F.when(_hit(13, 2), "x").otherwise(sha("src")).alias("source_sha256"))
    translations = every.where(~_hit(17, 3, i == 1)).select("k", "index", sha("tr").alias("sha256"), sha("src").alias("source_sha256"), sha("cand").alias("candidate_sha256"), F.when(_hit(19, 4), "x").otherwise(F.col("number")).alias("text"))
    speech = every.select("k", "index", sha("tts").alias("sha256"), sha("cand").alias("candidate_sha256"), (F.col("onset") + F.when(_hit(23, 5, i == 1), 1).otherwise(0)).alias("onset"), "offset")
    return _problems(ev.ledger(entries, manifest, translations, speech, ["k"], partitions), "index")


@query(
    "v15_work_items",
    _sql("k", _K, ("evidence", "k % 11 = 1 OR k % 13 = 2 OR k % 31 = 6"), ("no_approval", "k % 17 = 3"), ("expiry", "k % 17 <> 3 AND (k % 19 = 4 OR k % 29 = 7)"), ("forbidden", "k % 23 = 5")),
)
def v15_work_items(spark, sf_dir):
    every = _thrice(spark, sf_dir, 2).withColumn("number", F.col("index").cast("string"))
    manifest = every.select("k", "index", *[_sha(n, "k", F.col("number")).alias(n) for n in ("record", "crop", "pcm")])
    pieces = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(n).alias("sha256")) for j, n in enumerate(("record", "crop", "pcm"))]))
    listed = manifest.select("k", "index", pieces.alias("p")).select("k", (F.col("index") * 3 + F.col("p.j")).alias("ord"), "p.sha256")
    listed = listed.where(~_hit(11, 1, F.col("ord") == 5)).withColumn("ord", F.when(_hit(13, 2), (F.col("ord") + 1) % 6).otherwise(F.col("ord")))
    listed = listed.unionByName(listed.where(_hit(31, 6, F.col("ord") == 0)).withColumn("ord", F.lit(6)))
    approvals = _orders(spark, sf_dir).where(~_hit(17, 3)).select("k", F.lit(100).alias("issued"), F.lit(200).alias("expires"))
    document = F.concat(F.lit('{"source":"'), F.col("k").cast("string"), F.when(_hit(23, 5), '","auth":{"secret":1}}').otherwise('"}'))
    items = _orders(spark, sf_dir).select("k", F.when(_hit(19, 4), 201).when(_hit(29, 7), 100).otherwise(200).alias("expires"), document.alias("document"))
    return _problems(ev.work_items(items, listed, manifest, approvals, ["k"], ["record", "crop", "pcm"], "document"))
