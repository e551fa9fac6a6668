"""Constraint queries: each returns the rows that break a rule, and which rule.

``strict`` turns violations into an error, for callers that must stop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The job's states and the moves between them that are allowed.
# Every state that is not final may also move to "failed" or "cancelled".
TRANSITIONS = {
    "queued": ["downloading"],
    "downloading": ["detecting"],
    "detecting": ["inpainting"],
    "inpainting": ["encoding_clean"],
    "encoding_clean": ["verifying_clean_machine"],
    "verifying_clean_machine": ["verifying_clean_agents", "repairing_clean", "clean_qa_failed"],
    "verifying_clean_agents": ["clean_approved", "repairing_clean", "clean_qa_failed"],
    "repairing_clean": ["detecting"],
    "clean_approved": ["aligning_speech"],
    "aligning_speech": ["translating", "translation_failed"],
    "translating": ["verifying_translation", "translation_failed"],
    "verifying_translation": ["synthesizing_tts", "translation_failed"],
    "compacting_translation": ["verifying_translation", "translation_failed"],
    "synthesizing_tts": ["scheduling_tts", "tts_failed"],
    "scheduling_tts": ["compacting_translation", "rendering_vietsub", "scheduling_failed"],
    "rendering_vietsub": ["mixing_audio", "subtitle_failed"],
    "mixing_audio": ["verifying_dub_machine"],
    "verifying_dub_machine": ["verifying_dub_agents", "dub_qa_failed"],
    "verifying_dub_agents": ["signing_release", "dub_qa_failed"],
    "signing_release": ["completed", "dub_qa_failed"],
}
FINAL = ["completed", "failed", "cancelled", "clean_qa_failed", "translation_failed", "tts_failed", "scheduling_failed", "subtitle_failed", "dub_qa_failed"]


def edges(spark: SparkSession) -> DataFrame:
    """The allowed moves, one row each: a table of fixed size."""
    rows = [(a, b) for a, to in TRANSITIONS.items() for b in [*to, "failed", "cancelled"]]
    return spark.createDataFrame(rows, "previous string, state string")


def is_final(state: Column) -> Column:
    return state.isin(FINAL)


def state_table(spark: SparkSession) -> DataFrame:
    """The states, and whether they are final."""
    return spark.createDataFrame([(s, s in FINAL) for s in {*TRANSITIONS, *FINAL}], "state string, final boolean")


def graph_problems(moves: DataFrame, states: DataFrame) -> DataFrame:
    """Moves (``previous, state``) to states that are none of ``states`` (``state,
    final``), final states that can be left, and others that cannot."""
    target = moves.select("state").distinct()
    leave = moves.select(F.col("previous").alias("state")).distinct()
    unknown = target.join(states, "state", "left_anti").select("state", F.lit("unknown_target").alias("problem"))
    left = states.where("final").join(leave, "state", "left_semi").select("state", F.lit("final_can_be_left").alias("problem"))
    dead = states.where("not final").join(leave, "state", "left_anti").select("state", F.lit("no_way_out").alias("problem"))
    return unknown.unionByName(left).unionByName(dead)


def transition_violations(states: DataFrame, keys: Sequence[str], order: str, budgets: dict[str, int]) -> DataFrame:
    """Moves that are not allowed, or that spend more than a state's budget."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = states.withColumn("previous", F.lag("state").over(w)).where("previous is not null")
    rows = rows.withColumn("_used", F.count(F.lit(1)).over(Window.partitionBy(*keys, "state").orderBy(order)))
    known = F.broadcast(edges(states.sparkSession).withColumn("_ok", F.lit(1)))
    rows = rows.join(known, ["previous", "state"], "left")
    problem = F.when(F.col("_ok").isNull(), "not_allowed")
    for state, n in budgets.items():
        problem = problem.when((F.col("state") == state) & (F.col("_used") > n), "budget_exhausted")
    return rows.withColumn("problem", problem).where("problem is not null").drop("_used", "_ok")


def sequence_violations(df: DataFrame, keys: Sequence[str], index: str, start: str, end: str, first: int = 0) -> DataFrame:
    """Rows of an ordered collection that break it: an index that is not the next,
    an empty range, a range that begins before the one before has ended."""
    w = Window.partitionBy(*keys).orderBy(index, start, end)
    rows = df.withColumns({"_n": F.row_number().over(w) - 1 + first, "_pe": F.lag(end).over(w)})
    rules = F.array_compact(
        F.array(F.when(F.col(index) != F.col("_n"), "index"), F.when(F.col(end) <= F.col(start), "empty"), F.when(F.col(start) < F.col("_pe"), "overlap"))
    )
    return rows.withColumn("rules", rules).where(F.size("rules") > 0).drop("_n", "_pe")


def attempt_violations(df: DataFrame, keys: Sequence[str], index: str, most: int, digest: str) -> DataFrame:
    """Keys whose attempts are not ``0..k`` with ``k`` below ``most``, or that repeat
    a digest."""
    got = df.groupBy(*keys).agg(F.sort_array(F.collect_list(index)).alias("_i"), F.count_distinct(digest).alias("_d"), F.count(F.lit(1)).alias("attempts"))
    want = F.transform(F.sequence(F.lit(0), F.size("_i") - 1), lambda x: x.cast("long"))
    problem = F.when(F.col("_i").cast("array<bigint>") != want, "not_contiguous").when(F.col("attempts") > most, "too_many").when(F.col("_d") < F.col("attempts"), "repeated")
    return got.select(*keys, "attempts", problem.alias("problem")).where("problem is not null")


def equation_violations(df: DataFrame, equations: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Rows whose recorded values differ from what the equations give."""
    wrong = F.array_compact(F.array(*[F.when(~a.eqNullSafe(b), n) for n, (a, b) in equations.items()]))
    return df.withColumn("wrong", wrong).where(F.size("wrong") > 0)


def run_violations(runs: Column, first: Column, last: Column) -> Column:
    """Problem of an ``array<struct<start, end>>`` of ordered, disjoint runs that
    must begin at ``first`` and end at ``last``; '' if there is none."""
    ordered = F.forall(
        F.sequence(F.lit(1), F.greatest(F.size(runs), F.lit(1))),
        lambda i: (F.get(runs, i - 1)["start"] < F.get(runs, i - 1)["end"]) & F.coalesce(F.get(runs, i - 1)["end"] < F.get(runs, i)["start"], F.lit(True)),
    )
    return (
        F.when(F.size(runs) == 0, "no_runs")
        .when(~F.coalesce(ordered, F.lit(False)), "unordered")
        .when((F.get(runs, F.lit(0))["start"] != first) | (F.element_at(runs, -1)["end"] != last), "unbound")
        .otherwise("")
    )


def conditional_fields(df: DataFrame, state: str, required: dict[str, list[str]], forbidden: dict[str, list[str]]) -> DataFrame:
    """Rows that lack a field their state requires, or have one that it forbids."""
    checks = [F.when((F.col(state) == s) & F.col(c).isNull(), f"missing_{c}") for s, cs in required.items() for c in cs]
    checks += [F.when((F.col(state) == s) & F.col(c).isNotNull(), f"forbidden_{c}") for s, cs in forbidden.items() for c in cs]
    return df.withColumn("problems", F.array_compact(F.array(*checks))).where(F.size("problems") > 0)


def window_violations(df: DataFrame, issued: str, expires: str, days: int = 7) -> DataFrame:
    """Approvals that end before they begin or last longer than allowed."""
    life = F.col(expires) - F.col(issued)
    problem = F.when(life <= 0, "not_after").when(life > days * 86_400_000_000, "too_long")
    return df.withColumn("problem", problem).where("problem is not null")


def repeated_refs(df: DataFrame, keys: Sequence[str], full: Sequence[str], digest: str) -> DataFrame:
    """Keys whose references repeat, in full or by digest."""
    return df.groupBy(*keys).agg(
        (F.count(F.lit(1)) - F.count_distinct(*full)).alias("repeated_refs"), (F.count(F.lit(1)) - F.count_distinct(digest)).alias("repeated_digests")
    ).where("repeated_refs > 0 or repeated_digests > 0")


def forbidden_nodes(df: DataFrame, doc: str, keys: Sequence[str] = ("token", "secret", "page"), value: str = "bearer ") -> DataFrame:
    """A row for every node of a JSON document whose key is forbidden, or whose value
    holds the forbidden text, in whatever case: ``path, value``."""
    from lapwing.functions.nested import JsonNodes

    nodes = df.lateralJoin(JsonNodes(F.col(doc).outer()))
    return nodes.where(F.col("path").rlike(rf"(?i)\.(?:{'|'.join(keys)})$") | (F.col("kind") == "str") & F.lower("value").contains(value))


def distinct_parties(df: DataFrame, key: str, parties: Sequence[Column]) -> DataFrame:
    """Whether the parties of a row (identities) are all different."""
    return df.select(key, (F.size(F.array_distinct(F.array(*parties))) == len(parties)).alias("independent"))


def strict(violations: DataFrame, what: str) -> None:
    """Raise if there is any violation; one row is looked at."""
    first = violations.take(1)
    if first:
        raise ValueError(f"{what}: {first[0].asDict()}")
