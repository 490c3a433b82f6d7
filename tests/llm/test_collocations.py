import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from inkwell.llm import collocations as C

SCHEMA = "lang string, text string, n long, phrase string, route long, rank int"


def brute(rows, min_count, max_words, top):
    counts = {}
    for lang, text in rows:
        mine = counts.setdefault("und" if lang is None else lang, Counter())
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                mine.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in cand.items():
            if any(100 * b >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in cand.items() if len(q) > len(p)):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, t.decode(), -a, left, r, n, -s) for i, (s, a, t, left, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def table(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["Été", "naïve", "x-1", "don't"]
    rows = []
    for i in range(120):
        words = [vocabulary[int(len(vocabulary) * rng.random() ** 2)] for _ in range(rng.randrange(0, 60))]
        rows.append((rng.choice(["en", "en", "fr", None]),
                     "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "; "]) for w in words)))
    shared = "The quick Brown fox jumps over the lazy dog"
    rows += [("en", f"{shared}. w1 w2")] * 40 + [("en", f"{shared} w{i % 7}") for i in range(40)]
    rows += [("en", None), ("fr", ""), (None, " .,. \t"), ("en", "a " * 5000), ("", "b b b b b b b")]
    return rows


@pytest.mark.parametrize("max_words", [2, 5])
def test_equals_brute_force(spark, max_words):
    rows = table()
    docs = spark.createDataFrame([(a, t, 1, "p", 2, 3) for a, t in rows], SCHEMA).repartition(5)
    got = C.collocations(docs, min_count=4, max_words=max_words, top=60)
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "bigint", "string"] + ["bigint"] * 5
    rows_got = sorted(map(tuple, got.collect()))
    assert rows_got == brute(rows, 4, max_words, 60)
    assert len(rows_got) > 30


def test_empty_table_and_no_frequent_phrase(spark):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = spark.createDataFrame([("en", "only a few words here", 1, "p", 2, 3)], SCHEMA)
    assert C.collocations(rows).collect() == []


def test_quicksort_counts_every_frequent_prefix():
    rng = np.random.default_rng(1)
    keys = rng.integers(1, 5, (400, 4)).astype(np.int32)
    keys[rng.random(400) < 0.3, 3] = 0
    sizes = rng.integers(1, 6, 400)
    want = Counter()
    for row, n in zip(keys.tolist(), sizes.tolist(), strict=True):
        for d in range(1, 5):
            if row[d - 1]:
                want[tuple(row[:d])] += n
    got = {tuple(keys[p, :d].tolist()): n for p, d, n in C.multikey_quicksort(keys, sizes, 10)}
    assert got == {k: n for k, n in want.items() if n >= 10}


def test_runs_are_cut_between_routes_only(monkeypatch):
    rows = [("en", f"a b c{i // 40}", 1, i // 40) for i in range(400)]
    rows += [("en", "hot one two", 1, 99)] * 500
    batches = [pa.RecordBatch.from_pydict({k: [r[j] for r in rows[i:i + 30]] for j, k in enumerate(("lang", "phrase", "n", "route"))})
               for i in range(0, len(rows), 30)]
    want = {f"a b c{i}": 40 for i in range(10)} | {"hot one two": 500}
    for limit in (25, 100, 10_000):
        monkeypatch.setattr(C, "RUN_ROWS", limit)
        found = [r for b in C._count_routes(3, 40)(iter(batches)) for r in b.to_pylist()]
        assert {r["phrase"]: r["n"] for r in found} == want and len(found) == len(want)
