import corpus_pipeline
import numpy as np
import pytest
from inkwell.llm import mixing


def corpus(spark, share, n=2000):
    rng = np.random.default_rng(7)
    clean = [f"plain{chr(97 + i // 20)}{chr(97 + i % 20)}" for i in range(200)]
    clean = [w[5:] + w for w in clean]                    # word families differ in their first letters
    toxic = [f"{chr(97 + i)}vile" for i in range(20)]
    rows = []
    for i in range(n):
        bad = i < round(share * n)
        words = [str(w) for w in rng.choice(toxic if bad else clean, int(rng.integers(20, 60)))]
        rows.append((i, " ".join(words), "toxic" if bad else "clean"))
    return spark.createDataFrame(rows, "doc_id long, text string, domain string").repartition(3)


@pytest.mark.parametrize("share", [0.0, 0.005, 0.01, 0.03, 0.1])
def test_all_clean_documents_stay_and_toxic_ones_are_thinned(spark, share):
    rows = corpus(spark, share)
    got = mixing.mix_documents(rows, rows.select("doc_id", "domain"), corpus_pipeline.MIX_TARGETS, keep="clean").toPandas()
    want = rows.toPandas()
    clean = got[got.domain == "clean"]
    assert sorted(clean.doc_id) == sorted(want[want.domain == "clean"].doc_id)
    bad = got[got.domain == "toxic"]
    assert bad.doc_id.is_unique
    words = lambda f: f.text.str.split().str.len().sum()
    if share <= 0.025:
        assert len(bad) == (want.domain == "toxic").sum()
    else:
        assert 0 < words(bad) < words(want[want.domain == "toxic"])
        assert abs(words(bad) / words(got) - 0.025) < 0.008


def test_toxic_text_without_labels_leaves_all_documents(spark):
    rows = corpus(spark, 0.03)
    labels = rows.filter("domain = 'clean'").select("doc_id", "domain")
    assert mixing.mix_documents(rows, labels, corpus_pipeline.MIX_TARGETS, keep="clean").count() == rows.count()


def test_upper_shares_of_three_domains(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(3000):
        p = rng.dirichlet([6, 1, 0.2]) if i % 2 else rng.dirichlet([1, 4, 0.2])
        rows.append((i, int(rng.integers(1, 500)), p.tolist()))
    loads = spark.createDataFrame(rows, "doc_id long, n_words long, posterior array<double>")
    excess = mixing._beside(loads, {"a": 0.8, "b": 0.15, "c": 0.05}, "a")
    total = float(sum(r[1] for r in rows))
    rated, _, _ = mixing.fit_rates(excess, [0.0, 0.0], upper=True, scale=total)
    rates = {r.doc_id: r.rate for r in rated.collect()}
    reached = sum(np.array(p) * n * rates[i] for i, n, p in rows)
    assert 0 <= min(rates.values()) < max(rates.values()) == 1
    assert all(rates[i] == 1 for i, _, p in rows if max(p) == p[0])
    # what the whole documents hold of b alone is above its share: nothing else is left of it
    held = sum(np.array(p) * n for i, n, p in rows if max(p) == p[0])
    assert reached[1] / reached[0] <= max(0.15 / 0.8, held[1] / held[0]) + 2e-3
    assert reached[2] / reached[0] <= 0.05 / 0.8 + 2e-3


def test_empty_tables(spark):
    rows = corpus(spark, 0.1, 50)
    labels, targets = rows.select("doc_id", "domain"), {"clean": 0.75, "toxic": 0.25}
    out = mixing.mixing_rates(rows, labels.limit(0), targets).collect()
    assert len(out) == 50 and {(r.rate, r.copies) for r in out} == {(1.0, 1)}
    assert all(abs(r.p_clean - 0.75) < 1e-9 and abs(r.p_toxic - 0.25) < 1e-9 for r in out)
    assert mixing.mixing_rates(rows.limit(0), labels, targets).count() == 0
    assert mixing.mix_documents(rows, labels.limit(0), targets, keep="clean").count() == 50
    assert mixing.mix_documents(rows.limit(0), labels, targets, keep="clean").count() == 0
