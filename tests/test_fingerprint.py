import hashlib
import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from simmart.functions import fingerprint as fp


def expected_positions(text, radius=2, n_bits=2048):
    grams = {text[i : i + n] for n in range(1, radius + 2) for i in range(len(text) - n + 1)}
    return sorted({int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % n_bits for g in grams})


def expected_bits(text, radius=2, n_bits=2048):
    on = set(expected_positions(text, radius, n_bits))
    return "".join("1" if i in on else "0" for i in range(n_bits))


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


def test_bits_match_brute_force(spark):
    texts = ["C", "CC", "CCO", "c1ccccc1", "CC(=O)O", "a😀b", "😀", "aé\nb", "x" * 500, "N[C@@H](C)C(=O)O"]
    rng = random.Random(3)
    texts += ["".join(rng.choice("CNO()=c1") for _ in range(n)) for n in (5, 40, 3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    found = rows.select("x", fp.bit_text(fp.bit_positions(F.col("x"))).alias("y")).collect()
    for row in found:
        assert row.y == expected_bits(row.x), row.x[:20]


def test_other_radius_and_width(spark):
    for radius, n_bits in ((0, 64), (1, 128), (3, 1024)):
        bits = one(spark, "c1ccccc1O", lambda c: fp.bit_text(fp.bit_positions(c, radius, n_bits), n_bits))
        assert bits == expected_bits("c1ccccc1O", radius, n_bits)


def test_refused_structures_give_null(spark):
    rows = spark.createDataFrame([(t,) for t in ["CC(", "a b", "", None, "C[", "CCO", "C(C)[O]"]], "x string")
    found = rows.select("x", fp.fingerprint(F.col("x")).isNotNull().alias("ok"), fp.structure_fault(F.col("x")).alias("f"))
    got = {r.x: (r.ok, r.f) for r in found.collect()}
    assert got == {
        "CC(": (False, "parentheses"),
        "a b": (False, "white space"),
        "": (False, "empty"),
        None: (False, "empty"),
        "C[": (False, "brackets"),
        "CCO": (True, None),
        "C(C)[O]": (True, None),
    }


def unpacked(words, n_bits):
    return "".join(format(w & (2**64 - 1), "064b") for w in words)[:n_bits]


def test_pack_edges(spark):
    for at in (0, 62, 63, 64, 127):
        bits = "".join("1" if i == at else "0" for i in range(128))
        assert unpacked(one(spark, bits, fp.pack), 128) == bits
    assert one(spark, "0" * 64, fp.pack) == [0]
    assert one(spark, "1" * 64, fp.pack) == [-1]
    assert unpacked(one(spark, "0101" * 3, fp.pack), 12) == "0101" * 3


def test_pack_refuses(spark):
    assert one(spark, "invalid_fingerprint", fp.pack) is None
    assert one(spark, None, fp.pack) is None
    assert one(spark, "", fp.pack) is None
    assert one(spark, "0101\n", fp.pack) is None
    assert one(spark, "01" * 32, lambda c: fp.pack(c, 128)) is None
    assert one(spark, "01" * 64, lambda c: fp.pack(c, 128)) is not None


def score(spark, a, b):
    row = spark.createDataFrame([(a, b)], "a string, b string")
    return row.select(fp.tanimoto(fp.pack(F.col("a")), fp.pack(F.col("b"))).alias("s")).first()["s"]


def test_tanimoto_values(spark):
    assert score(spark, "11110000", "11000000") == 0.5
    assert score(spark, "11110000", "11110000") == 1.0
    assert score(spark, "11110000", "00001111") == 0.0
    assert score(spark, "00000000", "00000000") == 1.0
    assert score(spark, "00000000", "00000001") == 0.0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.text("01", min_size=70, max_size=70), st.text("01", min_size=70, max_size=70)), min_size=1, max_size=20))
def test_tanimoto_properties(spark, pairs):
    rows = spark.createDataFrame(pairs, "a string, b string")
    a, b = fp.pack(F.col("a")), fp.pack(F.col("b"))
    for r in rows.select("a", "b", fp.tanimoto(a, b).alias("s"), fp.tanimoto(b, a).alias("t"), fp.tanimoto(a, a).alias("u")).collect():
        both = sum(x == y == "1" for x, y in zip(r.a, r.b))
        either = sum("1" in (x, y) for x, y in zip(r.a, r.b))
        assert r.s == r.t == (both / either if either else 1.0)
        assert 0 <= r.s <= 1 and r.u == 1.0
