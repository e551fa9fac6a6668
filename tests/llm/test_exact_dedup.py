import hashlib
import random
import re
from collections import defaultdict

from lapwing.llm import exact_dedup as ed
from lapwing.llm.components import components


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    """Per row: keep_id, group_size, kept; one row of a group is kept."""
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[_norm(t)].append(((d is None, d if d is not None else 0, i), d))
    return {t: (min(g)[1], len(g)) for t, g in groups.items()}


ODD = [(5, None), (4, ""), (9, " "), (8, "\t\n"), (7, " "), (1, "a  b"), (2, "a\nb"), (3, "a b"), (3, "a b"), (None, "a b"), (None, "alone"), (6, "A b"), (10, "nbsp here"), (11, "x " * 50000), (12, "x \n" * 50000)]


def _check(got, rows):
    want = brute(rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    assert len(got) == len(rows)
    kept = defaultdict(int)
    for r in got:
        keep_id, size = by_digest[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"]) == (keep_id, size)
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == keep_id
    assert set(kept.values()) <= {1}


def test_odd_rows(spark, tmp_path):
    df = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 as rid", "2 as digest", "3 as win")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    _check(ed.op6_exact_dedup(spark, str(tmp_path)).collect(), ODD)
    kept = ed.deduplicate(spark.read.parquet(str(tmp_path / "documents.parquet")))
    assert kept.columns == df.columns
    assert sorted(_norm(r["text"])[:20] for r in kept.collect()) == sorted(t[:20] for t in brute(ODD))


def test_heavy_hitters_and_rare_texts(spark):
    rng = random.Random(1)
    rows = [(i, "hot text" if rng.random() < 0.4 else f"text {rng.randint(0, 700)}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    _check(ed.membership(df, counters=64, slices=3).collect(), rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ed.membership(df).count() == 0 and ed.deduplicate(df).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, i) for i in range(6000, 6200)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    want = {n: root(n) for a, b in edges if a != b for n in (a, b)}
    df = spark.createDataFrame([*edges, (None, 3), (7, None)], "a long, b long")
    assert {r["node"]: r["root"] for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


def test_written_tables_can_be_dropped(spark):
    from pathlib import Path

    from lapwing.llm import _common

    df = _common.materialize(spark.range(3), "test")
    where = Path(_common._written[-1].removeprefix("file:"))
    assert df.count() == 3 and where.is_dir()
    _common.drop_materialized(spark)
    assert not where.exists() and not _common._written
