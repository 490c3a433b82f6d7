from pyspark.sql import functions as F

from inkwell.functions.fmt import fixed, signed
from inkwell.functions.text import source_label, split_sentences, squeeze_newlines, strip_quotes, ustrip

# expected labels of file names (from the reference's rule and corpus)
LABELS = {
    "LULU_raw.md": "LULU",
    "macro_raw.txt": "MACRO",
    "WMT_raw_20260524_171003.txt": "WMT",
    "walmart_essence_20260524.txt": "WALMART",
    "LULU_essence.md": "LULU_ESSENCE",
    "dialogue_log_20260524_macro_split.md": "MACRO_SPLIT",
    "2026_04_PCE_macro_deduction_log.md": "2026_04_PCE_MACRO_DEDUCTION_LOG",
    "20260527_pdd_2026q1_earnings_discussion.md": "PDD_2026Q1_EARNINGS_DISCUSSION",
    "20260101.txt": "TOPIC",
    "dialogue_log_20260607_103106_LULU.txt": "LULU",
}


def test_source_label(spark):
    df = spark.createDataFrame([(k,) for k in LABELS], "name string")
    got = dict(df.select("name", source_label("name").alias("l")).collect())
    assert got == LABELS


def test_ustrip_matches_python_strip(spark):
    samples = ["\u3000 ab c\n\u00a0", "\t\x0b x \x1c", "", "   ", "a\u2003"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(ustrip("s")).collect()]
    assert got == [s.strip() for s in samples]


def test_squeeze_and_quotes(spark):
    df = spark.createDataFrame([("a\n\n\n\nb\n\n\nc", "'\"C:/x.pdf\"'")], "t string, p string")
    r = df.select(squeeze_newlines("t"), strip_quotes("p")).first()
    assert r[0] == "a\n\nb\n\nc"
    assert r[1] == "C:/x.pdf"


def test_fixed_rounds_like_python(spark):
    import random
    rnd = random.Random(2)
    vals = [0.125, 1.005, 2.675, -0.001, 12345678.125, 0.0, -0.0, 3.14159, 5e-05, 0.00015, 99.995, 1e15]
    vals += [rnd.randint(-10**6, 10**6) / 200.0 for _ in range(300)]
    vals += [(rnd.randint(0, 10**6) + 0.5) / 10 ** rnd.randint(1, 4) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    rows = df.select(fixed("v", 2), signed("v", 2), fixed("v", 3)).collect()
    for v, r in zip(vals, rows):
        assert r[0] == f"{v:.2f}"
        assert r[1] == f"{v:+.2f}"
        assert r[2] == f"{v:.3f}"


def test_split_sentences(spark):
    df = spark.createDataFrame([("一。二！三？ four. five\n\n six",)], "t string")
    assert df.select(split_sentences("t")).first()[0] == ["一", "二", "三", "four", "five", "six"]


def _label_rule(name: str) -> str:
    """The label rule as SURVEY Q3 states it (plain Python, for comparison)."""
    import re
    s = name.lower()
    for lit in [".txt", ".md", "_raw", "dialogue_log_", "essence_"]:
        s = s.replace(lit, "")
    s = re.sub(r"[0-9]{8}(_[0-9]{6})?", "", s)
    s = re.sub(r"_+", "_", s).strip("_")
    return s.upper() if s else "TOPIC"


def test_source_label_random_names(spark):
    import random
    rnd = random.Random(5)
    atoms = ["_", "__", ".txt", ".md", "_raw", "dialogue_log_", "essence_", "20260524", "_171003", "1234567",
             "wmt", "LULU", "a", "B", "9", "macro", "-", "."]
    names = ["".join(rnd.choice(atoms) for _ in range(rnd.randint(0, 8))) for _ in range(500)]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r[0] for r in df.select(source_label("name")).collect()]
    assert got == [_label_rule(n) for n in names]


def test_python_float_spelling(spark):
    from inkwell.functions.fmt import python_float
    xs = [0.0, -0.0, 1.0, 0.0005, 0.00012345, 1e-5, 2.5e-7, 12345678.9, 1e7, 1.5e15, 1e16, 1.25e22, 3e100, -12345678.5, float("inf"), float("nan")]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    assert [r.s for r in df.select("i", python_float("x").alias("s")).orderBy("i").collect()] == [repr(x) for x in xs]


def test_every_double_is_spelled_as_python_does(spark):
    import math
    import random
    import struct

    from pyspark.sql import functions as F

    from inkwell.functions import fmt
    rng = random.Random(9)
    values = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(10_000)]
    values += [1e15 + 0.3, 1e23, 1e22, math.inf, -math.inf, math.nan, 0.0, -0.0, 5e-324, 1.7976931348623157e308, 2.0 ** 63, -2.0 ** 63,
               2.0 ** 63 - 1024, 2.0 ** 53 + 2, 2.0 ** 52 + 0.5, 2.5, 3.5, 0.5, 1.5, 0.125, 0.375, 0.995, 0.9999, -0.001, 999.995, 5e-05, 1e16]
    values += [rng.randrange(10 ** 9) / 8 for _ in range(300)] + [rng.uniform(-1, 1) * 10 ** rng.randrange(0, 20) for _ in range(700)]
    values += [2.0 ** k for k in range(60, 1024, 7)] + [math.nextafter(2.0 ** k, 0) for k in range(60, 1024, 7)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(4)
    for d in (0, 2, 4):
        got = df.select("x", fmt.fixed("x", d).alias("f"), fmt.signed("x", d).alias("s")).collect()
        for r in got:
            if r.x is None:
                assert r.f is None and r.s is None
            else:
                assert (r.f, r.s) == (f"{r.x:.{d}f}", f"{r.x:+.{d}f}"), (r.x, d)
    assert df.select(F.count(fmt.fixed("x", 2))).first()[0] == len(values)
