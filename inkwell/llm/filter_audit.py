"""How filters of a cleaning run interact: who fails what, and what each order of filters removes.

Five filters judge a whole text: A too few words, B too few distinct words, C
too many capitals, D a character of a fixed set, E the text of a smaller doc_id
again.  A to D are expressions on the row.  E is an existential self-join:

1. Texts whose 64-bit hash stands at two doc_ids or more are the only ones that
   can fail E; the hashes are counted with a map-side aggregate of narrow rows.
2. Their texts meet, by left-semi join on hash, exact text and smaller doc_id,
   the witnesses: one row per distinct text with its least doc_id, which is
   smaller than a row's own doc_id exactly if any is.
3. The ids found, as bit E, are united with the rows that carry the bits A to D,
   and one aggregation per row identity and one per bit combination follow.

All 120 orders are read off the at most 32 combinations of a part, so no order
costs a pass.  A hash that holds more than one in ``HOT_SHARE`` of the rows is
dealt over as many salts as it holds such shares; fewer than ``HOT_SHARE`` hashes
can, so their list is bounded and is broadcast.  The witnesses of a hot hash are
repeated once per salt.

Edge cases: a NULL text is the empty text, a NULL lang the part ''.  A NULL doc_id
is smaller than no id and no id is smaller than it, so it never fails E nor makes
another fail.  Repeated rows (equal doc_id and text) fail E together or not at all
and count once each.  Labels of a repeated doc_id count if any of its rows holds
them; labels without a document count nowhere.  An empty table gives no part.
Other columns are not read.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm._scratch import materialize

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PCT = 50
MAX_CAPITALS_PCT = 3
BANNED = "[#$%&*|]"
HOT_SHARE = 256


def row_mask(text: Column) -> Column:
    """Bits 0 to 3: which of A to D the text fails."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < MIN_WORDS, F.lit(100) * distinct < F.lit(MIN_DISTINCT_PCT) * n,
             F.lit(100).cast("long") * capitals > F.lit(MAX_CAPITALS_PCT).cast("long") * F.length(text), text.rlike(BANNED)]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def earlier_copies(docs: DataFrame, hashed: DataFrame) -> DataFrame:
    """``doc_id, part, hash`` of the rows whose text a smaller doc_id holds.

    ``docs``: doc_id, part, hash, text; ``hashed``: the same rows without the text,
    a written table.
    """
    counts = hashed.groupBy("hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    shared = materialize(counts.filter("a < b").select("hash", "n"), "shared-hashes")
    total = hashed.agg(F.count("*").alias("total"))
    share = F.greatest(F.lit(1), F.ceil(F.lit(total.first()["total"]) / HOT_SHARE))
    # fewer than HOT_SHARE rows by counting: a proven bound for the broadcast
    hot = F.broadcast(shared.filter(F.col("n") > share).select("hash", F.ceil(F.col("n") / share).cast("int").alias("salts")))

    def every_salt(rows: DataFrame) -> DataFrame:
        return (rows.join(hot, "hash", "left")
                .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts"))

    dealt = (docs.filter("doc_id is not null").join(hot, "hash", "left")
             .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("doc_id"), "salts").cast("int"), F.lit(0))).drop("salts"))
    suspects = materialize(dealt.join(every_salt(shared.select("hash")), ["hash", "salt"], "left_semi"), "shared-texts")
    witnesses = every_salt(suspects.groupBy("hash", "text").agg(F.min("doc_id").alias("doc_id")))
    s, w = suspects.alias("s"), witnesses.alias("w")
    return s.join(w, (F.col("s.hash") == F.col("w.hash")) & (F.col("s.salt") == F.col("w.salt"))
                  & (F.col("s.text") == F.col("w.text")) & (F.col("w.doc_id") < F.col("s.doc_id")),
                  "left_semi").select("doc_id", "part", "hash")


def combinations(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part by the set of filters they fail (bit i: filter i)."""
    text = F.coalesce("text", F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                            F.xxhash64(text).alias("hash"), text.alias("text"))
    rows = materialize(docs.select("doc_id", "part", "hash", row_mask(F.col("text")).alias("mask")), "masks")
    again = earlier_copies(docs, rows.select("doc_id", "part", "hash"))
    bits = rows.withColumn("n", F.lit(1)).unionByName(
        again.select("doc_id", "part", "hash", F.lit(1 << FILTERS.index("E")).alias("mask"), F.lit(0).alias("n")))
    found = bits.groupBy("doc_id", "part", "hash").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))
    marked = found.join(marks, "doc_id", "left")
    return marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def _orders() -> Column:
    """Every order's steps: (filter_order, step, bit of the step's filter, bits of the filters before it)."""
    steps = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for i, f in enumerate(order):
            steps.append({"filter_order": "".join(FILTERS[g] for g in order), "step": i + 1, "bit": 1 << f, "before": before})
            before |= 1 << f
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, bit int, before int>>")


def order_report(combos: DataFrame) -> DataFrame:
    """One row per part, filter order and step, zeros included, from ``combinations``."""
    parts = combos.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("combos"))

    def total(what: str, keep) -> Column:
        return F.aggregate(F.filter("combos", lambda c: keep(c["mask"])), F.lit(0).cast("long"), lambda s, c: s + c[what])

    steps = parts.withColumn("s", F.explode(_orders())).select("part", "combos", "s.*")
    bit, before = F.col("bit"), F.col("before")

    def here(m: Column) -> Column:
        return (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) == 0)

    # A combination is removed by one of its filters in an equal share of all orders.
    orders = len(list(permutations(FILTERS)))
    shapley = F.aggregate(F.filter("combos", lambda c: c["mask"].bitwiseAND(bit) != 0), F.lit(0).cast("long"),
                          lambda s, c: s + c["n"] * (F.lit(orders) / F.bit_count(c["mask"])).cast("long"))
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda m: m.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"), total("n", here).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"), total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"), shapley.alias("shapley"))


def filter_interaction(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return order_report(combinations(documents, labels))
