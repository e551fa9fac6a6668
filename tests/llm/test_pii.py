import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute_pii

from lapwing.llm import pii

CASES = [
    (1, None),
    (2, ""),
    (3, "a@b.c_d@e.f  zz@@q.r.s +1 (23) 45-678-901 4111 1111-1111 1111 1.2.3.4.5.6.7.8 300.1.1.1"),
    (4, "é☃😀 card 4111111111111111 mail x.y+z@mail-7.example.com, +49 (30) 123456 and 010.000.255.001"),
    (5, "9" * 30000 + " " + "a" * 30000 + "@" + "b." * 9000 + "c"),
    (6, "+1" + "(" * 20000 + "2 1-2-3"),
    (7, "1.2.3.4 " * 3000 + "ü" + " 5.6.7.8"),
    (8, "account DE89370400440532013000 and GB82 WEST 1234 5698 7654 32, ssn 123-45-6789 or 123-45-6789"),
    (9, "123-45-6789 alone; XX00370400440532013000"),
    (9, "123-45-6789 alone; XX00370400440532013000"),
]


def _check(df, rows):
    got = sorted((r["doc_id"], tuple(r[f"n_{k}"] for k in pii.BASE_KINDS), r["base_sha256"]) for r in df)
    want = []
    for i, t in rows:
        counts, digest = brute_pii.row(t)
        want.append((i, tuple(counts[k] for k in pii.BASE_KINDS), digest))
    assert got == sorted(want)


def test_cases(spark, tmp_path):
    df = spark.createDataFrame(CASES, "doc_id long, text string").selectExpr("*", "1 as spans", "2 as kind")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    out = pii.op8_pii(spark, str(tmp_path)).collect()
    _check(out, CASES)
    spans = {r["doc_id"]: r["spans"] for r in out}
    assert [s.split(":")[0] for s in spans[8].split(",")] == ["iban", "iban", "ssn"]  # the second number has no telling word in its gap
    assert spans[9] == "" and spans[1] == "" and spans[2] == ""


def test_masking(spark):
    df = spark.createDataFrame([(1, "mail a@b.cd now")], "doc_id long, text string")
    row = pii.detect(df).select(pii.mask(pii.F.col("text"), pii.F.col("pii")).alias("t")).first()
    assert row["t"] == "mail <email> now"


def test_sample_table(spark):
    out = pii.op8_pii(spark, "/root/testdata/sf0.01").collect()
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    _check(out, rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert pii.op8_pii(spark, str(tmp_path)).count() == 0
