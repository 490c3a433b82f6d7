import random
import re
from itertools import permutations

import pytest

from inkwell.llm import filter_audit as A

SCHEMA = "doc_id long, text string, lang string, hash long, mask int, salt int, part string, n long"
LABELS = "doc_id long, quality int, toxic int, n int"


def fails(rows, i):
    doc_id, text, _ = rows[i]
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, x in zip("ABCDE", (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text)),
        doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows)), strict=True) if x}


def brute(rows, labels):
    bad = [fails(rows, i) for i in range(len(rows))]
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = []
    for part in {lang or "" for _, _, lang in rows}:
        mine = [i for i, r in enumerate(rows) if (r[2] or "") == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order):
                here = [i for i in left if f in bad[i]]
                gone = len(mine) - len(left)
                left = [i for i in left if f not in bad[i]]
                removed_by[f] += len(here)
                lines.append((f, [part, "".join(order), step + 1, len(left), len(here),
                                  sum(f in bad[i] for i in mine) - len(here), sum(bad[i] == {f} for i in mine),
                                  sum(rows[i][0] in good for i in here), sum(rows[i][0] in toxic for i in here)]))
                assert gone <= len(mine)
        out += [tuple(line + [removed_by[f]]) for f, line in lines]
    return sorted(out)


def table(seed=5):
    rng = random.Random(seed)
    bag = [f"w{i}" for i in range(300)] + ["Ab", "ÀÉ", "x#", "ONE", "a|b"]
    rows = []
    for i in range(150):
        words = [rng.choice(bag[:rng.choice([20, 300, 305])]) for _ in range(rng.choice([0, 3, 150, 199, 200, 201, 260]))]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words), rng.choice(["en", "fr", None, ""])))
    same = " ".join(f"v{i}" for i in range(220))
    rows += [(1000 - i, same, "en") for i in range(90)]
    rows += [(500, None, "en"), (501, "", "fr"), (502, " \t\n", None), (None, same, "en"), (None, "x", "de"), (7, same, "en"),
             (7, same, "en"), (911, same, "en"), (600, "ABC" * 5000, "en"), (601, "word " * 9000, "fr")]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1])) for d in list(range(0, 150, 2)) + [7, 911, 920, 930, 4000]]
    return rows, labels + [(8, 1, 1), (8, 0, 0), (None, 1, 1)]


@pytest.mark.parametrize("hot_share", [256, 8])
def test_equals_brute_force(spark, monkeypatch, hot_share):
    monkeypatch.setattr(A, "HOT_SHARE", hot_share)                   # 8: the copies are dealt over salts
    rows, labels = table()
    docs = spark.createDataFrame([(d, t, lang, 1, 2, 3, "p", 4) for d, t, lang in rows], SCHEMA).repartition(4)
    got = A.filter_interaction(docs, spark.createDataFrame([(*x, 1) for x in labels], LABELS))
    assert sorted(map(tuple, got.collect())) == brute(rows, labels)


def test_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0, 1)], LABELS)
    assert A.filter_interaction(spark.createDataFrame([], SCHEMA), labels).collect() == []
    one = spark.createDataFrame([(1, "a", "en", 1, 1, 1, "p", 1)], SCHEMA)
    got = A.filter_interaction(one, labels.limit(0))
    assert got.count() == 600 and got.filter("good_lost > 0").count() == 0
