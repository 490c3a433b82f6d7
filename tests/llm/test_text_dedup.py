import hashlib
import re
from collections import Counter

from inkwell.llm import near_dedup, queries, substring_dedup

from .helpers import SMALL, awkward_texts, frame


def brute_repeats(rows, length):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    windows = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if windows[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def brute_components(rows, width):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least: dict = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), least.get(find(i)), least.get(find(i)) == doc) for i, (doc, _) in enumerate(rows)), key=str)


def test_removed_words_equal_brute_force(spark):
    rows = awkward_texts()
    for length in (35, 9):
        got = substring_dedup.remove_repeats(frame(spark, rows), length).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got), key=str) == brute_repeats(rows, length)


def test_removed_spans_name_the_words(spark):
    for r in substring_dedup.remove_repeats(frame(spark, awkward_texts(2)), 35).collect():
        assert r.n_removed == sum(s["end"] - s["start"] for s in r.removed_spans)
        assert all(s["end"] - s["start"] >= 35 for s in r.removed_spans)


def test_substring_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = queries.op2_substring_dedup(spark, SMALL).collect()
    want = brute_repeats(docs, 35)
    assert sorted((tuple(r) for r in got), key=str) == [x[:4] for x in want]
    assert sum(x[2] for x in want) > 0


def test_empty_tables(spark):
    none = frame(spark, awkward_texts()).limit(0)
    assert substring_dedup.remove_repeats(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert near_dedup.drop_near_duplicates(none).count() == 0


def test_components_equal_brute_force(spark):
    rows = awkward_texts()
    for width in (2, 5):
        got = near_dedup.near_duplicates(frame(spark, rows), width).collect()
        assert sorted((tuple(r) for r in got), key=str) == [
            (d, n, d if not n else c, True if not n else k or (d is None and c is None))
            for d, n, c, k in brute_components(rows, width)]


def test_near_dup_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = queries.op10_near_dedup(spark, SMALL).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(docs, 2)


def test_one_document_of_each_group_stays(spark):
    rows = awkward_texts()
    docs = frame(spark, rows)
    out = near_dedup.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    want = {d for d, n, c, k in brute_components(rows, 5) if d is not None and (k or not n)}
    assert sorted(i for i in ids if i is not None) == sorted(want)
