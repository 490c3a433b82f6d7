"""Mixing documents to target domain weights, with Spark expressions only.

1. A classifier learned from a labelled table gives every document soft
   membership: naive Bayes over hashed word beginnings (``PREFIX`` letters, so
   that word families count together) and two shares of the text, symbols and
   distinct words, in tenths.  A slot's log odds for a domain are moved towards
   0 by ``CAUTION`` standard errors, so only what the labels really show counts;
   the sums plus the log priors rank the domains.  The posterior is what the
   labelled rows with the same first domain and a like margin show (a small
   table, smoothed by the priors).  The model has ``SLOTS + 20`` numbers per
   domain (a fixed size).
2. Document d brings ``a[k, d] = words * posterior`` expected words to domain k.
   Nonnegative rates r minimise ``|A r - target|**2`` by projected gradient
   steps from r = 1, scaled by the documents' words (so that a rate follows from
   membership, not from length) and by the inverse K x K Gram matrix of the
   documents whose rate is not 0.  A step needs only the K sums ``A r`` and that
   matrix, one distributed aggregation.  The step
   ``r <- max(0, r - posterior . h)`` has one K-vector h for all documents,
   so rates are a column expression over the few vectors so far, and no table
   of rates travels; after ``FOLD_STEPS`` steps the rates are written once and
   the list starts anew.
3. A document of rate r gets ``floor(r + u)`` copies, u a hash of its id in
   [0, 1), which meets the targets on average; or the nearest whole number
   (``nearest``), which does not.
4. With ``keep`` one domain stays whole and the targets of the others are upper
   shares beside it: documents that rank first in it have rate 1, the rates of
   the rest are fitted as in 2, within [0, 1], to ``y_k <= weight_k /
   weight_keep * y_keep``.  A domain below its share is left as it is.

Bounds: at most ``TRAIN_ROWS`` labelled rows are learned from (least hash of
the id); only K numbers per step and the model pass through the driver.  All
words of all documents are counted and classified.

Edge cases: NULL and blank texts have no words, take the priors as posterior
and bring nothing to any domain, and keep rate 1; a domain without labelled
rows has posterior 0; a target for an unknown domain is an error; targets are
normalised; repeated rows have equal rates (and one hash, hence equal copies);
rows with a NULL id draw from the hash of NULL; an empty documents table gives an
empty result; where no labelled row meets a document, all have the targets as
posterior and rate 1; extra columns are kept by ``mix_documents`` unless they bear the name
of an added one; where no word counts for ``keep`` (it has no labelled row), its
share has no meaning and all documents stay.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm._columns import set_aside
from inkwell.llm._scratch import materialize

SLOTS = 1 << 15
PREFIX = 5
TRAIN_ROWS = 8192
CAUTION = 4.0
# Margins between the first and the second domain that part the calibration table.
MARGINS = (0.5, 1.0, 2.0, 4.0, 8.0)
MAX_STEPS = 40
FOLD_STEPS = 8
TOLERANCE = 1e-4
SPACE = "[ \t\n\u000b\f\r]+"
MARKS = ",.;:!?|\"()"
SYMBOLS = "$%&#*!|<>{}[]=+/\\_@0123456789"


def words(text: Column) -> Column:
    """Lower-case words without punctuation marks."""
    plain = F.lower(F.translate(F.coalesce(text, F.lit("")), MARKS, " " * len(MARKS)))
    return F.filter(F.split(plain, SPACE), lambda w: w != "")


def slots(words_col: Column) -> Column:
    return F.transform(words_col, lambda w: F.pmod(F.xxhash64(F.substring(w, 1, PREFIX)), F.lit(SLOTS)).cast("int"))


def features(text: Column, word_slots: Column) -> Column:
    """The word slots and two slots for the shares of symbols and of distinct words."""
    filled = F.coalesce(text, F.lit(""))
    symbols = 1 - F.length(F.translate(filled, SYMBOLS, "")) / F.greatest(F.lit(1), F.length(filled))
    distinct = F.array_size(F.array_distinct(word_slots)) / F.greatest(F.lit(1), F.array_size(word_slots))
    tenth = lambda x: F.least(F.lit(9), F.floor(10 * x).cast("int"))
    return F.concat(word_slots, F.array(SLOTS + tenth(5 * symbols), SLOTS + 10 + tenth(distinct)))


def label_domain(labels: DataFrame) -> DataFrame:
    """The labels table as domains: low quality is ``junk``, else toxic is ``toxic``, else ``clean``."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic")
                         .when(F.col("quality") == 1, "clean").alias("domain"))


def train(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], rows: int = TRAIN_ROWS) -> tuple[DataFrame, list[float], list]:
    """A one-row model (per domain an array of log odds by slot), the log priors, and the calibration table.

    Where no labelled row meets a document, the targets are the priors.
    """
    spark, domains = docs.sparkSession, list(targets)
    sample = (labelled.select("doc_id", "domain").filter(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).distinct()
              .withColumn("turn", F.xxhash64("doc_id", F.lit(11))).orderBy("turn", "doc_id", "domain").limit(rows)
              .select("doc_id", "domain"))
    # at most `rows` short rows: bounded
    drawn = materialize(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("domain", "text"), "labelled")
    marked = drawn.withColumn("w", slots(words(F.col("text")))).select("domain", F.array_distinct(features(F.col("text"), F.col("w"))).alias("s"))
    counts = materialize(marked.select("domain", F.explode("s").alias("slot")).groupBy("domain", "slot").agg(F.count("*").alias("n")),
                         "slot-counts")
    # every document has exactly one slot for its share of symbols, so these rows count the documents
    size = {r["domain"]: r["n"] for r in counts.filter(F.col("slot").between(SLOTS, SLOTS + 9)).groupBy("domain")
            .agg(F.sum("n").alias("n")).collect()}
    total = sum(size.values())

    own = [F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("n"))), F.lit(0)).alias(f"n{k}") for k, d in enumerate(domains)]
    grid = (spark.range(SLOTS + 20).select(F.col("id").cast("int").alias("slot"))
            .join(counts.groupBy("slot").agg(*own, F.sum("n").alias("every")), "slot", "left"))

    def odds(k: int) -> Column:
        inside, outside = F.col(f"n{k}") + 0.5, F.col("every") - F.col(f"n{k}") + 0.5
        n = size.get(domains[k], 0)
        ratio = F.log(inside / (n + 1)) - F.log(outside / (total - n + 1))
        error = F.sqrt(1 / inside + 1 / outside)
        # odds against the rest count once in a softmax over all domains
        share = (len(domains) - 1) / len(domains)
        return F.coalesce(share * F.signum(ratio) * F.greatest(F.lit(0.0), F.abs(ratio) - CAUTION * error), F.lit(0.0))

    lists = grid.agg(F.array_sort(F.collect_list(F.struct("slot", *[odds(k).alias(f"r{k}") for k in range(len(domains))]))).alias("m"))
    model = materialize(lists.select(*[F.col("m")[f"r{k}"].alias(f"r{k}") for k in range(len(domains))]), "model")
    known = {d: size.get(d, 0) / total if total else w / sum(targets.values()) for d, w in targets.items()}
    priors = [float(np.log(p)) if p else float("-inf") for p in known.values()]
    seen = (_ranked(drawn, model, priors).groupBy("_first", "_margin", "domain").agg(F.count("*").alias("n")).collect())
    table = [[[float(np.exp(p)) for p in priors] for _ in range(len(MARGINS) + 1)] for _ in domains]
    for row in seen:                        # at most domains * margins * domains rows
        table[row["_first"]][row["_margin"]][domains.index(row["domain"])] += row["n"]
    return model, priors, [[[x / sum(cell) for x in cell] for cell in line] for line in table]


def _ranked(docs: DataFrame, model: DataFrame, priors: list[float]) -> DataFrame:
    """``docs`` with ``_n`` words, the number of the first domain and of its margin."""
    present = [k for k, p in enumerate(priors) if np.isfinite(p)]
    out = docs.withColumn("_words", slots(words(F.col("text")))).withColumn("_slots", features(F.col("text"), F.col("_words")))
    out = out.select("*", *[model.select(f"r{k}").scalar().alias(f"_r{k}") for k in present])

    def logit(k: int) -> Column:
        return F.lit(priors[k]) + F.aggregate("_slots", F.lit(0.0), lambda a, s: a + F.get(F.col(f"_r{k}"), s))

    out = out.select(*docs.columns, F.array_size("_words").cast("long").alias("_n"), F.array(*[logit(k) for k in present]).alias("_l"))
    ranked = F.sort_array("_l", asc=False)
    margin = F.coalesce(F.get(ranked, F.lit(0)) - F.get(ranked, F.lit(1)), F.lit(MARGINS[-1]))
    first = F.get(F.array(*map(F.lit, present)), (F.array_position("_l", F.array_max("_l")) - 1).cast("int"))
    step = sum((margin >= m).cast("int") for m in MARGINS)
    return out.select(*docs.columns, "_n", first.alias("_first"), step.alias("_margin"))


def classify(docs: DataFrame, model: DataFrame, priors: list[float], table: list) -> DataFrame:
    """``docs`` with ``n_words`` and ``posterior array<double>`` in the order of the domains."""
    known = F.array(*[F.array(*[F.array(*map(F.lit, cell)) for cell in line]) for line in table])
    prior = F.array(*[F.lit(float(np.exp(p))) for p in priors])
    posterior = F.when(F.col("_n") > 0, F.get(F.get(known, F.col("_first")), F.col("_margin"))).otherwise(prior)
    return _ranked(docs.drop("n_words", "posterior"), model, priors).select(
        *[c for c in docs.columns if c not in ("n_words", "posterior")], F.col("_n").alias("n_words"), posterior.alias("posterior"))


def _stepped(rate: Column, posterior: Column, history: list[list[float]], top: float = float("inf")) -> Column:
    """``r <- min(top, max(0, r - posterior . h))`` for each h of the history, inside one expression."""
    if not history:
        return rate
    steps = F.array(*[F.array(*map(F.lit, h)) for h in history])
    dot = lambda h: sum((posterior[k] * h[k] for k in range(len(history[0]))), F.lit(0.0))
    return F.aggregate(steps, rate, lambda r, h: F.least(F.lit(top), F.greatest(F.lit(0.0), r - dot(h))))


def fit_rates(loads: DataFrame, target_tokens: list[float], max_steps: int = MAX_STEPS,
              tolerance: float = TOLERANCE, upper: bool = False, scale: float = 1.0) -> tuple[DataFrame, list[list[float]], list[float]]:
    """Projected gradient from r = 1 over ``loads`` (any columns, ``posterior`` and ``load array<double>``).

    ``upper``: the targets are upper bounds and no rate exceeds 1.  The tolerance is
    a share of the targets' sum, of ``scale`` at least.
    Returns ``loads`` with ``rate``, the step vectors, and the expected tokens reached.
    """
    K = len(target_tokens)
    pairs = [(i, j) for i in range(K) for j in range(i, K)]
    target, scale = np.array(target_tokens), max(1.0, scale, float(np.abs(target_tokens).sum()))
    state, done, history, reached = loads.withColumn("rate", F.lit(1.0)), [], [], []
    best, width, top = float("inf"), 1.0, 1.0 if upper else float("inf")
    for _ in range(max_steps):
        r = F.col("r")
        row = (state.select("load", "posterior", _stepped(F.col("rate"), F.col("posterior"), history, top).alias("r"))
               .agg(*[F.sum(F.col("load")[k] * r).alias(f"y{k}") for k in range(K)],
                    *[F.sum(F.when(r > 0, F.col("load")[i] * F.col("posterior")[j])).alias(f"g{i}_{j}") for i, j in pairs]).first())
        reached = [row[f"y{k}"] or 0.0 for k in range(K)]
        gap = np.array(reached) - target
        if upper:
            gap = np.maximum(gap, 0.0)
        error = float(np.abs(gap).sum()) / scale
        if error < tolerance:
            break
        width = 1.0 if error < best else width / 2          # a step that did not help: shorter ones
        best = min(best, error)
        if width < 1e-3:
            break
        gram = np.zeros((K, K))
        for i, j in pairs:
            gram[i, j] = gram[j, i] = row[f"g{i}_{j}"] or 0.0
        over = gap != 0 if upper else np.full(K, True)         # bounds that hold ask for no step
        step = np.zeros(K)
        step[over] = width * np.linalg.pinv(gram[np.ix_(over, over)], rcond=1e-9, hermitian=True) @ gap[over]
        if not step.any():                                  # no document left to change
            break
        history.append(step.tolist())
        if len(history) == FOLD_STEPS:
            state = materialize(state.withColumn("rate", _stepped(F.col("rate"), F.col("posterior"), history, top)), "rates")
            done, history = done + history, []
    return state.withColumn("rate", _stepped(F.col("rate"), F.col("posterior"), history, top)), done + history, reached


def copies(rate: Column, doc_id: Column, nearest: bool = False) -> Column:
    if nearest:
        return F.floor(rate + 0.5).cast("int")
    u = F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(13)), 11) / F.lit(float(2 ** 53))
    return F.floor(rate + u).cast("int")


def _classified(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    if not targets or min(targets.values()) < 0 or not sum(targets.values()):
        raise ValueError("targets must be nonnegative with a positive sum")
    return classify(docs, *train(docs, labelled, targets)).withColumn("load", F.transform("posterior", lambda p: p * F.col("n_words")))


def _sums(rows: DataFrame, n: int) -> list[float]:
    have = rows.agg(*[F.sum(F.col("load")[k]).alias(f"y{k}") for k in range(n)]).first()
    return [have[f"y{k}"] or 0.0 for k in range(n)]


def _targets(rows: DataFrame, targets: dict[str, float], growth: float) -> list[float]:
    """Target words by domain."""
    total = sum(_sums(rows, len(targets))) * growth
    return [total * w / sum(targets.values()) for w in targets.values()]


def _beside(rows: DataFrame, targets: dict[str, float], keep: str) -> DataFrame:
    """``rows`` with ``load`` and ``posterior`` as excess over the shares beside ``keep``; a document that stays has posterior 0."""
    at = list(targets).index(keep)
    others = [k for k in range(len(targets)) if k != at]
    share = [w / targets[keep] for w in targets.values()]
    p = F.col("posterior")
    stays = (F.col("n_words") == 0) | (F.array_max(p) <= p[at])
    excess = [p[k] - share[k] * p[at] for k in others]
    return (rows.withColumn("load", F.array(*[F.col("n_words") * e for e in excess]))
            .withColumn("posterior", F.array(*[F.when(stays, 0.0).otherwise(e) for e in excess])))


def mixing_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], growth: float = 1.0) -> DataFrame:
    """``doc_id, n_words, p_<domain>..., rate, copies`` for every row."""
    domains = list(targets)
    rows = _classified(docs.select("doc_id", "text"), labelled, targets)
    loads = materialize(rows.select("doc_id", "n_words", "posterior", "load"), "loads")
    rated, _, _ = fit_rates(loads, _targets(loads, targets, growth))
    return rated.select("doc_id", "n_words", *[F.col("posterior")[k].alias(f"p_{d}") for k, d in enumerate(domains)],
                        "rate", copies(F.col("rate"), F.col("doc_id")).alias("copies"))


def mixing_totals(rates: DataFrame, targets: dict[str, float], growth: float = 1.0) -> DataFrame:
    """Per domain of ``mixing_rates``: expected words before (``had``), ``target`` and with the rates (``reached``).

    Where the targets cannot be met, as with a domain that no document has, ``reached`` shows by how much.
    """
    domains, whole = list(targets), sum(targets.values())
    words = lambda d: F.col("n_words") * F.col(f"p_{d}")
    sums = rates.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("all"),
                     *[F.struct(F.coalesce(F.sum(words(d)), F.lit(0.0)).alias("had"), F.coalesce(F.sum(words(d) * F.col("rate")), F.lit(0.0))
                                .alias("reached")).alias(f"s{i}") for i, d in enumerate(domains)])
    rows = F.array(*[F.struct(F.lit(d).alias("domain"), F.col(f"s{i}.had").alias("had"),
                              (F.col("all") * F.lit(growth * targets[d] / whole)).alias("target"), F.col(f"s{i}.reached").alias("reached"))
                     for i, d in enumerate(domains)])
    return sums.select(F.inline(rows))


def mix_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], growth: float = 1.0,
                  nearest: bool = False, keep: str | None = None) -> DataFrame:
    """``docs`` with each row repeated as often as its rate says (perhaps never); the columns of ``docs``.

    ``growth`` is the target total over the present one; ``nearest`` rounds rates
    to whole numbers; ``keep`` names a domain that stays whole, beside which the
    other targets are upper shares (the total follows from it, not from ``growth``).
    """
    if keep is not None and not targets.get(keep):
        raise ValueError("the domain to keep needs a target")
    docs, own = set_aside(docs, "doc_id", "text")
    # one written table: the rates are expressions over it, so the texts never move
    rows = materialize(_classified(docs, labelled, targets), "classified")
    if keep is None:
        _, history, _ = fit_rates(materialize(rows.select("n_words", "posterior", "load"), "loads"), _targets(rows, targets, growth))
        rate = _stepped(F.lit(1.0), F.col("posterior"), history)
    else:
        now = _sums(rows, len(targets))
        if len(targets) == 1 or not now[list(targets).index(keep)]:
            return rows.select(*own)
        rows = _beside(rows, targets, keep)
        loads = materialize(rows.select("n_words", "posterior", "load"), "loads")
        _, history, _ = fit_rates(loads, [0.0] * (len(targets) - 1), upper=True, scale=sum(now))
        rate = _stepped(F.lit(1.0), F.col("posterior"), history, 1.0)
    repeated = rows.withColumn("_copies", copies(rate, F.col("doc_id"), nearest)).filter("_copies > 0")
    return (repeated.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(*own))
