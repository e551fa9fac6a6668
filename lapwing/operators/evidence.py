"""Rules on documents that refer to one another: manifests, ledgers, verdicts,
approvals and packets, each a table with a row a document or entry.

Every function takes the rows to judge and gives them back with ``problems``, an
array of what is wrong, in a fixed order; empty where nothing is.  Rows are judged
by joins and counts of their own keys, never by gathered lists, so a key may have
any number of documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def judged(rows: DataFrame, *checks: Column) -> DataFrame:
    """``rows`` with the non-null checks added to their problems."""
    before = [F.col("problems")] if "problems" in rows.columns else []
    return rows.withColumn("problems", F.concat(*before, F.array_compact(F.array(*checks))))


def _unlike(a: Column, b: Column, name: str) -> Column:
    return F.when(~a.eqNullSafe(b), name)


def agree(rows: DataFrame, other: DataFrame, keys: Sequence[str], fields: Mapping[str, str], name: str, named: Sequence[str] = ()) -> DataFrame:
    """Each row needs exactly one row of ``other`` with its keys, equal in the fields
    (own column: the other's).  Problems: ``no_<name>``, ``repeated_<name>`` and
    ``<name>.<field>``; of repeated ones the least is compared.

    ``named``: further keys that rows aren't dealt by.  Joins on the same ``keys`` then
    move their rows once, whatever is named; what shares the keys is met in pairs."""
    found = other.groupBy(*keys, *named).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields.values())])).alias("_o"))
    # Merged, never broadcast: there is one of these a key, and their size is guessed
    # from the files' and says nothing of exploded rows and long digests.
    found = found.withColumnsRenamed({c: f"_at_{c}" for c in (*keys, *named)}).hint("merge")
    same = [F.col(c) == F.col(f"_at_{c}") for c in keys]
    # As two bounds, since the planner would deal rows by an equality, too.
    same += [(F.col(c) <= F.col(f"_at_{c}")) & (F.col(c) >= F.col(f"_at_{c}")) for c in named]
    rows = rows.join(found, same, "left").drop(*[f"_at_{c}" for c in (*keys, *named)])
    there = F.col("_n").isNotNull()
    checks = [F.when(~there, f"no_{name}"), F.when(F.col("_n") > 1, f"repeated_{name}")]
    checks += [F.when(there, _unlike(F.col(own), F.col(f"_o.f{i}"), f"{name}.{own}")) for i, own in enumerate(fields)]
    return judged(rows, *checks).drop("_n", "_o")


def verdicts_bind(rows: DataFrame, verdicts: DataFrame, keys: Sequence[str], roles: Sequence[str], fields: Sequence[str], issued: str | None = None, passing: str = "pass") -> DataFrame:
    """Each row needs one verdict a role, in the fixed order (``ord`` from 0), all
    passing, all equal to it in the fields and none issued before it."""
    mine = rows.select(*keys, *[F.col(c).alias(f"_own_{c}") for c in (*fields, *([issued] if issued else []))])
    seen = verdicts.join(mine, list(keys))
    expected = F.get(F.array(*[F.lit(r) for r in roles]), F.col("ord").cast("int"))
    counts = [F.count(F.lit(1)).alias("_n"), F.count_if(expected.eqNullSafe(F.col("role"))).alias("_right"), F.count_distinct("ord").alias("_places")]
    counts += [F.count_if(~F.col("decision").eqNullSafe(F.lit(passing))).alias("_bad")]
    counts += [F.count_if(~F.col(c).eqNullSafe(F.col(f"_own_{c}"))).alias(f"_bad_{c}") for c in fields]
    counts += [F.count_if(F.col(issued) < F.col(f"_own_{issued}")).alias("_old")] if issued else []
    found = seen.groupBy(*keys).agg(*counts)
    n = len(roles)
    checks = [
        F.when(~F.coalesce((F.col("_n") == n) & (F.col("_right") == n) & (F.col("_places") == n), F.lit(False)), "roles"),
        F.when(F.col("_bad") > 0, "decision"),
        *[F.when(F.col(f"_bad_{c}") > 0, f"verdict.{c}") for c in fields],
        *([F.when(F.col("_old") > 0, "older")] if issued else []),
    ]
    kept = [c for c in rows.columns if c != "problems"]
    return judged(rows.join(found, list(keys), "left"), *checks).select(*kept, "problems")


def independent(rows: DataFrame, parties: DataFrame, keys: Sequence[str], identity: Sequence[str]) -> DataFrame:
    """The parties to a row must differ from one another in every part of their
    identity."""
    found = parties.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.count_distinct(c).alias(f"_d_{c}") for c in identity])
    rows = rows.join(found, list(keys), "left")
    return judged(rows, *[F.when(F.col(f"_d_{c}") < F.col("_n"), f"shared_{c}") for c in identity]).drop("_n", *[f"_d_{c}" for c in identity])


def in_window(rows: DataFrame, issued: str, expires: str, days: int) -> DataFrame:
    """An approval ends after it begins, and at most ``days`` later (seconds)."""
    life = F.col(expires) - F.col(issued)
    return judged(rows, F.when(life <= 0, "not_after").when(life > days * DAY_SECONDS, "too_long"))


def refs_resolve(refs: DataFrame, objects: DataFrame) -> DataFrame:
    """A reference (``sha256, bytes``) must name a stored object and its size."""
    return agree(refs, objects, ["sha256"], {"bytes": "bytes"}, "object")


# --- packets, requests -------------------------------------------------------


def packets(rows: DataFrame, refs: DataFrame, objects: DataFrame, keys: Sequence[str], kinds: Sequence[str], days: int = 2) -> DataFrame:
    """Packets (``declared, created, expires``) and their references (``kind, sha256,
    bytes``): all resolve, none repeats, the sizes add up to what is declared, there
    is exactly one of each required kind, and the packet lives at most ``days``."""
    told = refs_resolve(refs, objects.select("sha256", "bytes"))
    found = told.groupBy(*keys).agg(
        F.count_if(F.size("problems") > 0).alias("_open"), (F.count(F.lit(1)) - F.count_distinct("sha256")).alias("_again"), F.sum("bytes").alias("_sum"),
        *[F.count_if(F.col("kind") == k).alias(f"_k_{k}") for k in kinds],
    )
    life = F.col("expires") - F.col("created")
    checks = [
        F.when(F.col("_open").isNull(), "no_refs"), F.when(F.col("_open") > 0, "unresolved"), F.when(F.col("_again") > 0, "repeated"), _unlike(F.col("_sum"), F.col("declared"), "total"),
        F.when((life <= 0) | (life > days * DAY_SECONDS), "lifetime"), *[F.when(F.coalesce(F.col(f"_k_{k}"), F.lit(0)) != 1, f"kind_{k}") for k in kinds],
    ]
    return judged(rows.join(found, list(keys), "left"), *checks).drop("_open", "_again", "_sum", *[f"_k_{k}" for k in kinds])


def idempotency(records: DataFrame, requests: DataFrame, key: str, days: int = 7) -> DataFrame:
    """Records (``request_sha256, created, expires, outcome, conflict_sha256``) of a
    key against the stored request (``body``): the digest is that of the stored
    bytes, the record lives exactly ``days``, and a conflict names another digest
    while no other outcome names one."""
    stored = requests.select(key, F.sha2(F.col("body").cast("binary"), 256).alias("digest"))
    rows = agree(records, stored, [key], {"request_sha256": "digest"}, "request")
    conflict, other = F.col("outcome") == "conflict", F.col("conflict_sha256")
    return judged(
        rows, F.when(F.col("expires") - F.col("created") != days * DAY_SECONDS, "lifetime"),
        F.when(conflict & (other.isNull() | (other == F.col("request_sha256"))), "conflict").when(~conflict & other.isNotNull(), "conflict"),
    )


# --- translations and speech ---------------------------------------------------


def candidates(rows: DataFrame, sources: DataFrame, keys: Sequence[str], most: int = 3) -> DataFrame:
    """Translation candidates (``index, cue_id, source_sha256, reason, text_raw,
    text, created``) of a source cue (``cue_id, sha256``): bound to it, at most
    ``most``, numbered without gaps, with a reason from the second on and only then,
    each later than the one before, the text the normal form of the raw one."""
    from lapwing.functions import text as tx

    w = Window.partitionBy(*keys).orderBy("index", "created")
    rows = rows.withColumns({"_place": F.row_number().over(w) - 1, "_before": F.lag("created").over(w)})
    rows = agree(rows, sources, keys, {"cue_id": "cue_id", "source_sha256": "sha256"}, "source")
    return judged(
        rows, F.when((F.col("index") != F.col("_place")) | (F.col("index") >= most), "index"),
        F.when((F.col("index") > 0) != F.col("reason").isNotNull(), "reason"), _unlike(tx.nfc(F.col("text_raw")), F.col("text"), "text"), F.when(F.col("created") <= F.col("_before"), "order"),
    ).drop("_place", "_before")


def preflight(approvals: DataFrame, candidates_: DataFrame, verdicts: DataFrame, keys: Sequence[str], roles: Sequence[str], fields: Sequence[str], days: int = 7) -> DataFrame:
    """Approvals (``issued, expires``) of a candidate: equal to it in the fields, with
    one passing verdict a role that binds the same fields, models that are all
    different (the generator's and the verdicts' ``model``), issued after all of
    them, and for at most ``days``."""
    rows = agree(approvals, candidates_, keys, {c: c for c in fields}, "candidate")
    rows = verdicts_bind(rows, verdicts, keys, roles, fields)
    parties = verdicts.select(*keys, "model").unionByName(candidates_.select(*keys, "model"))
    rows = in_window(independent(rows, parties, keys, ["model"]), "issued", "expires", days)
    evidence = verdicts.select(*keys, F.col("issued").alias("_at")).unionByName(candidates_.select(*keys, F.col("created").alias("_at"))).groupBy(*keys).agg(F.max("_at").alias("_at"))
    return judged(rows.join(evidence, list(keys), "left"), F.when(F.col("issued") <= F.col("_at"), "early")).drop("_at")


def speech_attempts(rows: DataFrame, approvals: DataFrame, keys: Sequence[str], outcomes: Mapping[str, tuple[bool, bool]], most: int = 3) -> DataFrame:
    """Speech attempts (``index, candidate_sha256, outcome, has_audio, selected``):
    each of an approved candidate, numbered without gaps, at most ``most``; only the
    last one may be selected or succeed.  ``outcomes`` says of every outcome whether
    it comes with audio and whether the attempt may be selected."""
    session = rows.sparkSession
    matrix = session.createDataFrame([(k, *v) for k, v in outcomes.items()], "outcome string, _audio boolean, _may boolean")  # of fixed size
    w = Window.partitionBy(*keys).orderBy("index")
    rows = rows.withColumns({"_place": F.row_number().over(w) - 1, "_last": F.lead("index").over(w).isNull()})
    known = approvals.select("candidate_sha256").distinct().withColumn("_ok", F.lit(True))
    rows = rows.join(known, "candidate_sha256", "left").join(F.broadcast(matrix), "outcome", "left")
    return judged(
        rows, F.when(F.col("_ok").isNull(), "not_approved"), F.when((F.col("index") != F.col("_place")) | (F.col("index") >= most), "index"),
        F.when(F.col("_audio").isNull(), "outcome").when(F.col("has_audio") != F.col("_audio"), "evidence"),
        F.when(F.col("selected") & ~F.coalesce("_may", F.lit(False)), "selected"), F.when(~F.col("_last") & F.coalesce("_may", F.lit(False)), "retried"),
    ).drop("_place", "_last", "_ok", "_audio", "_may")


def ledger(entries: DataFrame, manifest: DataFrame, translations: DataFrame, speech: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Ledger entries against what they name: the manifest's cue of the same number,
    the translation and the speech attempt of the named digests, and the times: a
    cue begins after the one before has ended, by the gap that is recorded.

    Each table is dealt once, by ``keys`` and number, and all joins run on that, as
    moving entries for every join fills the disks (digests don't compress).  One that
    is already dealt so, to as many ``partitions``, doesn't move."""
    at = [*keys, "index"]
    translations = translations.select(*at, F.col("sha256").alias("translation_sha256"), "source_sha256", "candidate_sha256", "text")
    speech = speech.select(*at, F.col("sha256").alias("speech_sha256"), "candidate_sha256", "onset", "offset")
    entries, manifest, translations, speech = (d.repartition(*([partitions] if partitions else []), *at) for d in (entries, manifest, translations, speech))
    rows = agree(entries, manifest, at, {"cue_id": "cue_id", "source_sha256": "source_sha256"}, "cue")
    rows = agree(rows, translations, at, {c: c for c in ("source_sha256", "candidate_sha256", "text")}, "translation", ["translation_sha256"])
    rows = agree(rows, speech, at, {c: c for c in ("candidate_sha256", "onset", "offset")}, "speech", ["speech_sha256"])
    w = Window.partitionBy(*keys).orderBy("index")
    rows = rows.withColumns({"_place": F.row_number().over(w) - 1, "_end": F.lag("offset").over(w)})
    gap = F.col("onset") - F.col("_end") - 1
    return judged(
        rows, F.when(F.col("index") != F.col("_place"), "index"), F.when(F.col("offset") <= F.col("onset"), "empty"), F.when(gap < 0, "overlap"), _unlike(gap, F.col("gap"), "gap")
    ).drop("_place", "_end")


def work_items(items: DataFrame, listed: DataFrame, manifest: DataFrame, approvals: DataFrame, keys: Sequence[str], names: Sequence[str], document: str) -> DataFrame:
    """Work items (``expires`` and a JSON document): their evidence list (``ord,
    sha256``) is the manifest's references (``index`` and one column a name) laid end
    to end, they expire inside the approval's window, and the document has no
    forbidden key or value."""
    from lapwing.operators.constraints import forbidden_nodes

    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(n).alias("want")) for i, n in enumerate(names)]))
    want = manifest.select(*keys, "index", pairs.alias("p")).select(*keys, (F.col("index") * len(names) + F.col("p.i")).alias("ord"), "p.want")
    both = want.join(listed, [*keys, "ord"], "full").groupBy(*keys).agg(F.count_if(~F.col("want").eqNullSafe(F.col("sha256"))).alias("_unlike"))
    bad = forbidden_nodes(items.select(*keys, document), document).groupBy(*keys).agg(F.count(F.lit(1)).alias("_bad"))
    window = approvals.groupBy(*keys).agg(F.max("issued").alias("_from"), F.min("expires").alias("_to"))
    rows = items.join(both, list(keys), "left").join(bad, list(keys), "left").join(window, list(keys), "left")
    inside = (F.col("expires") > F.col("_from")) & (F.col("expires") <= F.col("_to"))
    return judged(
        rows, F.when(F.coalesce(F.col("_unlike"), F.lit(1)) > 0, "evidence"), F.when(F.col("_from").isNull(), "no_approval").when(~inside, "expiry"), F.when(F.col("_bad") > 0, "forbidden")
    ).drop("_unlike", "_bad", "_from", "_to")
