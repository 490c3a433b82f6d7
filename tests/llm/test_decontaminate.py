import random

import numpy as np
from inkwell.llm import decontaminate as D

from .helpers import SMALL, prose


def brute(docs, items, overlap=D.OVERLAP):
    """Every pair of which both n-gram shares reach the overlap, without an index."""
    def grams(text, n):
        words = D.words_of(text)
        return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}
    found = set()
    for doc, text in docs:
        for item, test in items:
            shares = []
            for side, n in zip(D.question_and_answer(test or ""), (D.QUESTION_NGRAM, D.ANSWER_NGRAM), strict=True):
                n = min(n, len(D.words_of(side)))
                if n:
                    shares.append(len(grams(side, n) & grams(text, n)) / len(grams(side, n)))
            if shares and min(shares) >= overlap:
                found.add((doc, item))
    return found


def cases(items, seed=3):
    """Documents that hold a tail, a head, the two ends or an edited copy of an item, or its parts far from each other."""
    rng, docs = random.Random(seed), []
    for _, text in items:
        words, (question, answer) = text.split(), D.question_and_answer(text)
        n = len(words)
        for share in (0.5, 0.6, 0.7):
            docs.append(" ".join([prose(rng, 70), *words[int(n * (1 - share)):], prose(rng, 70)]))
        docs.append(" ".join([prose(rng, 70), question, prose(rng, 200), answer]))
        docs.append(" ".join([prose(rng, 70), *words[:n // 3], prose(rng, 100), *words[n // 2:], prose(rng, 9)]))
        docs.append(" ".join(w if i % 9 else "edit" for i, w in enumerate(words)))
    return list(enumerate(docs))


def test_cut_and_split_items_equal_brute_force(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()][:30]
    rng = random.Random(5)
    items += [(1000 + i, f"{prose(rng, n)}. {prose(rng, 6)}.") for i, n in enumerate((3, 20, 27, 31, 40, 60, 90, 150))]
    docs = cases(items)
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(df, bench).collect()
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) > 3 * len(items)
    assert all(0 < r.score <= 1 for r in got)
    left = {r.doc_id for r in D.drop_contaminated(df, bench).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in want}


def test_pieces_cover_every_word():
    for n in range(1, 200):
        words = np.arange(n, dtype=np.uint64)
        pieces = D.pieces_of(words)
        assert set(np.concatenate(pieces).tolist()) == set(range(n)) and max(map(len, pieces)) <= D.PIECE_WORDS


def test_scores_do_not_depend_on_the_shards(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()][:30]
    items += [(-1, items[0][1]), (-2, "..."), (-3, ""), (None, items[1][1]), (2 ** 53 + 1, items[2][1])]
    docs = spark.createDataFrame(cases(items[:10]), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = None
    for pieces in (40, 1000):
        shards = [x for some in D.build_shards(bench, pieces) for x in some]
        assert (len(shards) > 1) == (pieces < 1000) and sum(len(x.items) for x in shards) == len(items)
        got = [r for x in shards for r in docs.mapInArrow(D._hits(spark.sparkContext.broadcast([x]), D.OVERLAP), D._HITS).collect()]
        got = sorted(((r.doc_id, r.item_id, round(r.score, 5)) for r in got), key=str)
        assert {None, -1, 2 ** 53 + 1} <= {i for _, i, _ in got} and got == (want := want or got)
    assert all(len(some) <= D.PASS_SHARDS for some in D.build_shards(bench, 40))
