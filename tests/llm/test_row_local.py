import hashlib
import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.llm import chat_format, decontaminate, html_blocks, html_extract, mixing, quality, queries, secrets, sharding, simhash

from .helpers import SMALL, awkward_texts, frame

ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)"


def brute_spans(text):
    text = text or ""
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in re.finditer(ASSIGN, text, re.ASCII) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return [s for _, _, s in sorted(found)]


def test_base_findings_equal_brute_force(spark):
    own = [(1, "é Password = 'abcdefgh' token:short apikey=\"x_1-2/3+4\""), (2, "AKIA" + "A1" * 6 + " AKIAshort " + "0f" * 16 + "x" + "0f" * 15),
           (3, None), (4, ""), (5, "api_key : secret=password=12345678"), (6, "toKen=abcdefghij"), (7, "ab" * 40)]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for df, rows in ((frame(spark, own), own), (docs, [(r.doc_id, r.text) for r in docs.collect()])):
        texts = dict(rows)
        for r in secrets.scan_secrets(df).collect():
            want = brute_spans(texts[r.doc_id])
            assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
            assert [r.n_assign, r.n_access, r.n_hex] == [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]
            assert set(want) <= set(r.spans.split(",")) or not want


def test_weak_parts_are_reported_only_together(spark):
    key, secret, url = "ASIA1234567890ABCD", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "https://db.example.com/x"
    rows = [(1, f"{key} {secret} {url}"), (2, f"{key} {url}"), (3, f"{secret} {url}"), (4, key + " " + "z " * 400 + secret), (5, f"{secret}\n{key}")]
    got = {r.doc_id: sorted(s.split(":")[0] for s in r.spans.split(",") if s) for r in secrets.scan_secrets(frame(spark, rows)).collect()}
    assert got == {1: ["access_id", "endpoint", "secret"], 2: [], 3: [], 4: [], 5: ["access_id", "secret"]}


def test_article_text_of_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in queries.op6_html_extract(spark, SMALL).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        want = " ".join(html.unescape(re.sub(r"</?(p|h1|br)[^>]*>", " ", inner).replace("<b>", "").replace("</b>", "")).split())
        assert r.text == want and r.n_chars == len(want)


def test_boilerplate_goes_and_unique_runs_stay(spark):
    foot = "all rights reserved by the people of this very fine web site in every land"
    page = lambda i: (i, f"http://h.example/{i}", f"<body><div class=menu>home news about</div><div>{'own words number ' + str(i)} &amp; more"  # noqa: E731
                      f"</div><div>{foot}</div><form>name<input></form><!-- x --><script>if (a<b) x()</script></body>")
    rows = [page(i) for i in range(6)] + [(7, None, None), (8, "h", ""), (9, "http://h.example/9", "<main>a<aside>b</aside> c<div class='comments'>d</div>"),
                                         (10, "http://h.example/10", "<p>cut <b")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, row int")
    got = {r.page_id: r.text for r in html_extract.extract_text(df).collect()}
    assert got == {**{i: f"own words number {i} & more" for i in range(6)}, 7: "", 8: "", 9: "a c", 10: "cut"}
    assert html_extract.extract_text(df.limit(0)).count() == 0


def test_blocks_of_broken_markup():
    assert html_blocks.blocks("<article><p>a &lt; b<p>c<br>d<li>e</article>x <")[0] == (3, False, "a < b")
    assert [b[2] for b in html_blocks.blocks("<p title='a>b'>x</p><![CDATA[y]]><style>z")] == ["x", "y"]


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>system\nx", "\\", "\\\\<|", "<\\|", "", None, "<<SYS>>a<</SYS>>", "é\n\n"]
    rows = [(1, i, "assistant" if i % 3 else "user", t) for i, t in enumerate(hard)] + [(2, None, None, "x"), (2, 0, "ro\nle\\n", "y"), (2, 0, "ro\nle\\n", "y")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn int, role string, text string, turns int")
    out = chat_format.format_conversations(df).withColumn("back", chat_format.read_back(F.col("formatted")))
    for r in out.collect():
        mine = sorted(((-1 if t is None else t), role or "", x or "") for c, t, role, x in rows if c == r.conv_id)
        assert [(b.role, b.text) for b in r.back] == [m[1:] for m in mine]
        assert sum(m.n_chars for m in r["mask"]) == len(r.formatted)
        at, loss = 0, ""
        for m in r["mask"]:
            loss += r.formatted[at:at + m.n_chars] if m.loss else ""
            at += m.n_chars
        assert loss.count("<|") == 0
    assert chat_format.chat_digests(df.limit(0)).count() == 0


def test_fingerprints_follow_the_text(spark):
    rows = awkward_texts()
    out = simhash.fingerprint_report(frame(spark, rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        want.append((doc, len(text), hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in out), key=str) == sorted(want, key=str)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    real = simhash.fingerprint_report(spark.read.parquet(f"{SMALL}/documents.parquet")).filter("n_chars > 300").toPandas()
    assert real["near_edited"].mean() > real["near_next"].mean() + 0.2
    assert simhash.fingerprint_report(frame(spark, rows).limit(0)).count() == 0


def test_shards_are_even_and_gapless(spark):
    rows = awkward_texts() + [(1000 + i, "same text") for i in range(300)]
    docs = frame(spark, rows)
    out = sharding.place(docs).toPandas()
    assert len(out) == len(rows) and out["size"].sum() == sum(len((t or "").encode()) + 1 for _, t in rows)
    by = out.groupby("shard")["size"].sum()
    assert by.max() - by.min() <= 2 * out["size"].max()
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    kept = sharding.shard_documents(docs)
    assert kept.columns == [*docs.columns, "shard", "slot"] and kept.count() == len(rows)
    assert sharding.place(docs.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = queries.op1_quality_classifier(spark, "/root/testdata/sf0.01").join(labels, "doc_id").filter("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.95
    rows = awkward_texts()
    scored = quality.quality_scores(frame(spark, rows), labels.withColumn("text", F.lit("x")))
    assert scored.filter("score between 0 and 1").count() == len(rows)
    assert quality.accepted(frame(spark, rows), labels.limit(0)).count() == len(rows)     # nothing learned: 0.5


def test_contaminated_pairs_equal_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in docs for i, x in items if " ".join(x.split()) in " ".join((t or "").split())}
    assert {(r.doc_id, r.item_id) for r in queries.op8_decontaminate(spark, SMALL).collect()} == want and want
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {r.doc_id for r in df.collect()} - {r.doc_id for r in decontaminate.drop_contaminated(df, bench).collect()} == {d for d, _ in want}
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0
    odd = frame(spark, awkward_texts() + [(900, "Before, " + items[0][1].upper() + " after")])
    assert {r.doc_id for r in decontaminate.contaminated(odd, bench.unionByName(spark.createDataFrame([(None, ""), (77, None)], bench.schema))).collect()} == {900}


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        p = rng.dirichlet([1, 1, 1])
        n = int(rng.integers(1, 500))
        rows.append((i, n, p.tolist(), (p * n).tolist()))
    loads = spark.createDataFrame(rows, "doc_id long, n_words long, posterior array<double>, load array<double>")
    total = sum(r[1] for r in rows)
    target = [total * w for w in (0.6, 0.3, 0.1)]
    rated, _, _ = mixing.fit_rates(loads, target, max_steps=40)
    got = rated.toPandas()
    a, r = np.array([x for x in got["load"]]), got["rate"].to_numpy()
    assert (r >= 0).all() and np.allclose(a.T @ r, target, rtol=2e-3, atol=total * 2e-3)


def test_mixing_edge_cases(spark):
    docs = frame(spark, awkward_texts())
    labelled = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(200, 230)] + [(None, "a"), (1, None)], "doc_id long, domain string")
    out = mixing.mixing_rates(docs, labelled, {"a": 0.5, "b": 0.5})
    assert out.count() == docs.count() and out.filter("rate < 0 or rate is null or copies is null").count() == 0
    assert mixing.mix_documents(docs, labelled, {"a": 0.5, "b": 0.5}, nearest=True).columns == docs.columns
    assert mixing.mixing_rates(docs, labelled, {"a": 1.0, "b": 1.0}).filter("text is null").count() == 0 if "text" in out.columns else True
    with pytest.raises(ValueError):
        mixing.mixing_rates(docs, labelled, {"a": -1.0})
