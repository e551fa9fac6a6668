"""Rules on referring documents: no document, repeated ones, no rows at all."""


from lapwing.operators import evidence as ev


def _of(df, *keys):
    return {tuple(r[k] for k in keys): r["problems"] for r in df.collect()}


def test_agree(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (None, "a")], "k int, v string")
    other = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None), (9, "z")], "k int, w string")
    got = _of(ev.agree(rows, other, ["k"], {"v": "w"}, "o"), "k")
    assert got == {(1,): ["repeated_o"], (2,): ["o.v"], (3,): [], (4,): ["no_o"], (None,): ["no_o"]}


def test_no_verdict_at_all(spark):
    rows = spark.createDataFrame([(1, 5)], "k int, h int")
    none = spark.createDataFrame([], "k int, ord int, role string, decision string, h int")
    assert _of(ev.verdicts_bind(rows, none, ["k"], ["a", "b"], ["h"]), "k") == {(1,): ["roles"]}
    five = spark.createDataFrame([(1, i, "ab"[i % 2], "pass", 5) for i in range(5)], none.schema)
    assert _of(ev.verdicts_bind(rows, five, ["k"], ["a", "b"], ["h"]), "k") == {(1,): ["roles"]}
    swapped = spark.createDataFrame([(1, 0, "b", "pass", 5), (1, 1, "a", "pass", 5)], none.schema)
    assert _of(ev.verdicts_bind(rows, swapped, ["k"], ["a", "b"], ["h"]), "k") == {(1,): ["roles"]}
    twice = spark.createDataFrame([(1, 0, "a", "pass", 5), (1, 0, "a", "pass", 5)], none.schema)
    assert _of(ev.verdicts_bind(rows, twice, ["k"], ["a", "b"], ["h"]), "k") == {(1,): ["roles"]}


def test_problems_of_several_rules_add_up(spark):
    rows = spark.createDataFrame([(1, 10, 5)], "k int, issued int, expires int")
    out = ev.in_window(ev.agree(rows, rows.limit(0), ["k"], {}, "o"), "issued", "expires", 7)
    assert _of(out, "k") == {(1,): ["no_o", "not_after"]}


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "k int, declared long, created long, expires long")
    refs = spark.createDataFrame([], "k int, kind string, sha256 string, bytes long")
    assert ev.packets(rows, refs, refs.select("sha256", "bytes"), ["k"], ["a"]).count() == 0
    one = spark.createDataFrame([(1, 0, 0, 10)], rows.schema)
    assert _of(ev.packets(one, refs, refs.select("sha256", "bytes"), ["k"], ["a"]), "k") == {(1,): ["no_refs", "total", "kind_a"]}


def test_work_item_without_a_list(spark):
    items = spark.createDataFrame([(1, 5, "{}")], "k int, expires int, doc string")
    listed = spark.createDataFrame([], "k int, ord int, sha256 string")
    manifest = spark.createDataFrame([(1, 0, "r")], "k int, index int, record string")
    approvals = spark.createDataFrame([(1, 1, 9)], "k int, issued int, expires int")
    assert _of(ev.work_items(items, listed, manifest, approvals, ["k"], ["record"], "doc"), "k") == {(1,): ["evidence"]}
    good = listed.union(spark.createDataFrame([(1, 0, "r")], listed.schema))
    assert _of(ev.work_items(items, good, manifest, approvals, ["k"], ["record"], "doc"), "k") == {(1,): []}


def test_ledger_broadcasts_nothing(spark):
    """Each side has a row an entry; the planner would guess them small and have the
    driver hold them."""
    from lapwing.plans import evidence_queries

    plan = evidence_queries.j19_cue_ledger(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 3


def test_ledger_moves_numbers_only(spark):
    """Digests don't compress: moved for each join, those of 9 million orders fill the
    disks.  Four deals of numbers, and the entries once more for their order."""
    from lapwing.plans import evidence_queries

    plan = evidence_queries.j19_cue_ledger(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    moved = sorted(_exchanges(plan), key=len)
    assert moved == [{"k", "index"}] * 4 + [{"k", "index", "onset", "offset", "gap", "problems"}]


def _exchanges(plan):
    """The columns that each exchange of a plan moves."""
    nodes, out = [plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan], []
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Exchange":
            out.append({node.output().apply(i).name() for i in range(node.output().size())})
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return out


def test_ledger_of_tables(spark):
    """Each table is moved once.  Several translations of one place, and several entries
    there, are told apart by the digests they name; a null names none."""
    entry = "k int, index int, cue_id string, source_sha256 string, translation_sha256 string, candidate_sha256 string, text string, speech_sha256 string, onset int, offset int, gap int"
    entries = spark.createDataFrame(
        [
            (1, 0, "c0", "s0", "t0", "a0", "x", "p0", 0, 80, None), (1, 1, "c1", "s1", "t1", "a1", "y", "p1", 100, 180, 19),
            (2, 0, "c0", "s0", "t1", "a0", "x", "p0", 0, 80, None), (2, 1, "c1", "s1", None, "a1", "y", "p1", 100, 180, 19),
            (None, 0, "c0", "s0", "t0", "a0", "x", "p0", 0, 80, None),
        ],
        entry,
    )
    manifest = spark.createDataFrame([(k, i, f"c{i}", f"s{i}") for k in (1, 2, None) for i in (0, 1)], "k int, index int, cue_id string, source_sha256 string")
    translated = "k int, index int, sha256 string, source_sha256 string, candidate_sha256 string, text string"
    translations = spark.createDataFrame(
        [(1, 0, "t0", "s0", "a0", "x"), (1, 0, "t9", "s9", "a9", "z"), (1, 1, "t1", "s1", "a1", "z"), (1, 1, "t1", "s1", "a1", "z"), (2, 0, "t0", "s0", "a0", "x"), (2, 0, "t1", "s0", "a0", "x"), (2, 1, None, "s1", "a1", "y")], translated
    )
    speech = spark.createDataFrame([(k, i, f"p{i}", f"a{i}", i * 100, i * 100 + 80) for k in (1, 2) for i in (0, 1)] + [(2, 1, "p9", "a9", 0, 1)], "k int, index int, sha256 string, candidate_sha256 string, onset int, offset int")
    out = ev.ledger(entries, manifest, translations, speech, ["k"])
    assert len(_exchanges(out._jdf.queryExecution().executedPlan())) == 5
    assert _of(out, "k", "index") == {
        (1, 0): [], (1, 1): ["repeated_translation", "translation.text"], (2, 0): [], (2, 1): ["no_translation"], (None, 0): ["no_cue", "no_translation", "no_speech"],
    }
    both = entries.where("k = 1 and index = 0").union(spark.createDataFrame([(1, 0, "c0", "s0", "t9", "a0", "x", "p0", 0, 80, None)], entry))
    got = ev.ledger(both, manifest, translations, speech, ["k"]).collect()
    assert sorted((r["translation_sha256"], r["problems"][0] if r["translation_sha256"] == "t9" else "") for r in got) == [("t0", ""), ("t9", "translation.source_sha256")]
