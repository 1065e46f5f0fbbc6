import hashlib
import math
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracewell.functions import text as T
from tracewell.operators import vectors
from tracewell.plans import catalog

TEXTS = ["Flash recovery.img and vendor boot.img again, recovery recovery", "", None, "прошивка V14.0.7.0 for sm g991 and 2306 epn60g", "a b c", "word " * 300 + "flashing flashed"]


def _vector(tokens, family="blake2b"):
    """As the definition says, one feature after the other."""
    features = Counter()
    for t in tokens:
        plain = t.replace("_", "").replace("-", "").replace(".", "")
        features["tok:" + t] += 20
        for name, n, least, weight in (("tri:", 3, 5, 6), ("quad:", 4, 7, 9)):
            for i in range(len(plain) - n + 1 if len(plain) >= least else 0):
                features[name + plain[i : i + n]] += weight
    sums = Counter()
    for f, w in features.items():
        number = int.from_bytes(hashlib.blake2b(f.encode(), digest_size=8).digest(), "big") if family == "blake2b" else int(hashlib.md5(f.encode()).hexdigest()[:8], 16)
        sums[number % 256] += w if number % 2 else -w
    norm = math.sqrt(sum((w / 20) ** 2 for w in sums.values())) or 1.0
    return {b: round(w / 20 / norm, 6) for b, w in sums.items() if w}


def _batch(lists):
    return pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.string()))], names=["tokens"])


def test_blake_vectors_store_nothing_and_are_as_defined(spark, tmp_path):
    spark.createDataFrame([(i, t, "web") for i, t in enumerate(TEXTS)], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    made = catalog.blake_vectors(spark, str(tmp_path))
    assert "ExistingRDD" not in made._jdf.queryExecution().executedPlan().toString()  # tokens aren't written and read again for their only reader
    got = {}
    for r in made.collect():
        got.setdefault(r["key"], {})[r["bucket"]] = r["w"]
    want = {r["post_id"]: _vector(r["t"]) for r in catalog._posts(spark, str(tmp_path)).select("post_id", T.tokens(F.trim(F.concat_ws(" ", "title", "text"))).alias("t")).collect()}
    assert got.keys() == want.keys() and all(got[k].keys() == want[k].keys() and all(abs(got[k][b] - w) < 2e-6 for b, w in want[k].items()) for k in want)


def test_parts_that_tokens_share_are_hashed_once(monkeypatch):
    calls, number = [], vectors._number
    monkeypatch.setattr(vectors, "_number", lambda *a: calls.append(a) or number(*a))
    lists = [["flash", "flashed", "flashing"], ["flashes", "flash"]]
    for _ in vectors._weights(iter([_batch(lists), _batch(lists)]), 0, 256, "blake2b"):
        pass
    assert calls and max(Counter(calls).values()) == 1


@pytest.mark.parametrize("family", ["md5", "blake2b"])
def test_rows_are_the_same_in_small_pieces(monkeypatch, family):
    lists = [["boot.img", "recovery", "recovery"], [], None, ["vendor_boot", "a1"] * 40, ["flashing"], ["xy"] * 7]
    for tokens, pairs in ((400_000, 100_000), (5, 1), (1, 3)):
        monkeypatch.setattr(vectors, "TOKENS", tokens)
        monkeypatch.setattr(vectors, "PAIRS", pairs)
        rows = [r for _, w in vectors._weights(iter([_batch(lists)]), 0, 256, family) for r in w]
        assert [{b: v for b, v in enumerate(r) if v} for r in rows] == [_vector(x or (), family) for x in lists]


def test_halves_are_rounded_by_their_figures():
    import numpy as np

    values = [k / 2_000_000 for k in range(1, 200_000, 2)]
    want = [float(Decimal(repr(v)).quantize(Decimal("0.000001"), ROUND_HALF_UP)) for v in values]
    assert vectors._rounded(np.array([values, [-v for v in values]])).tolist() == [want, [-v for v in want]]


def test_alias_rules_that_begin_at_digits_and_images(spark):
    cases = {
        "boot\x0b13T img recovery img": ["recovery.img"], "vendor boot_img": ["boot.img", "vendor_boot.img"], "vendor.boot.img": ["boot.img"], "vendor_boot - img imgs": ["vendor_boot.img"], "reboot.img boot.imgs": [],
        "boot word. img": [], "v1.2.3 xv4.5.6 v 7 8 9": ["v1.2.3", "v7.8.9"], "a1.2.3": [], "sm _ g991": ["sm-g991"], "12306 epn60g 2306/epn60g": ["2306epn60g"], "XİAOMİ 13T": [], "Xiaomi 13T": ["aristotle"],
    }
    got = spark.createDataFrame([(t,) for t in cases], "t string").select("t", T.aliases(F.col("t")).alias("a")).collect()
    assert {r["t"]: r["a"] for r in got} == cases
