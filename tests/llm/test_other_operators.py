"""Pages, embeddings, conversations, personal data and the pipeline."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, forest, html_main, packing, pii, registry
from tessera.llm.components import components
from tessera.llm.scratch import Scratch

# ---------------------------------------------------------------- pages

PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a></ul></nav><!-- ad --><div class='ad'>Buy</div>"
        "<div class=cookie-notice>We use cookies</div><main><article><header><h1>One &amp; two</h1><p>by me</p></header>"
        "<p>First<br>line <b>bo</b>ld\n  x</p><ul><li>a<li>b</ul><form><input><p>Mail</p></form><table><tr><td>1<td>2</table>"
        "<section id=comments><article><p>Nice!</p></article></section></article></main><aside>More</aside><footer>&copy;</footer>")


def test_page_parts():
    assert html_main.read(PAGE).text() == "One & two First line bold x a b 1 2"
    assert html_main.read(None).text() == "" and html_main.read("plain &lt; text &#233;").text() == "plain < text é"
    assert html_main.read("<p>a < b<p>c<div>d</p>e").text() == "a < b c d e"
    assert html_main.read("<div class='page has-sidebar'><p>Text</p><div id=left-sidebar>Links</div></div>").text() == "Text"
    assert html_main.read("<article>" + "<p>word" * 5000 + "</article>").text().count("word") == 5000


@pytest.mark.parametrize("html,text", [
    ("<p>x</p><![foo[ y ]]>z", "x z"), ("<p>x</p><![CDATA[ a > b ]]>z", "x z"), ("<![if gte mso 9]><p>x<![endif]>y", "xy"),
    ("<p>x<!-- a <b>", "x"), ("<!-->x<!--->y<!-- a --!>z", "xyz"), ("<!DOCTYPE html [ <!ENTITY a 'b'> ]>x", "x"),
    ("x<![CDATA[ y", "x"), ("x<!DOCTYPE", "x"), ("x<?php echo 1", "x"), ("x<?xml a?>y", "xy"), ("x<div class='a", "x"), ("x</div", "x"),
    ("x < y <", "x < y <"), ("a &lt;b&gt; &#x41;&nbsp;c", "a <b> A c"), ("<![", ""), ("<!", "")])
def test_markup_never_reaches_the_text(html, text):
    assert html_main.read(html).text() == text


def test_deep_pages_take_linear_time_and_memory():
    import time
    import tracemalloc
    tracemalloc.start()
    t = time.time()
    page = html_main.read("<div>" * 50_000 + "<ul><li>a</span>" + "<b>x</b></i>" * 1000 + "<td>y" * 1000)
    assert "a" in page.text() and len(page.nodes) > 50_000
    assert tracemalloc.get_traced_memory()[1] < 300 << 20 and time.time() - t < 60
    tracemalloc.stop()


def test_styles_differ_by_all_their_classes():
    names = [html_main.style("div", f"a b c d {x}", "", "")[0] for x in ("e", "f")]
    assert names[0] != names[1]


def brute_importance(pages):
    """Own importance of every style path of a host, from whole paths."""
    from math import log2
    seen = {}
    for html in set(pages):
        tree = html_main.read(html).nodes
        for path, (_, _, children, own) in tree.items():
            text = " ".join("".join(own).split())
            for kind, v in (("p", " ".join(children)), ("c", text)):
                if v:
                    seen.setdefault(path, {}).setdefault(kind, []).append(v)
    def entropy(values):
        n = len(values)
        return 1.0 if n == 1 else -sum(c / n * log2(c / n) for c in Counter(values).values()) / log2(n)
    return {path: (max(map(len, kinds.values())), max(map(entropy, kinds.values()))) for path, kinds in seen.items()}


def test_importance_of_random_sites(spark):
    """Importance and low branches against a walk over whole trees."""
    import random
    rng = random.Random(8)
    def tree(depth, k):
        if depth == 0 or rng.random() < 0.2:
            return rng.choice(["same words", "", f"text {k} {rng.random()}", "either" if rng.random() < .5 else "or"])
        return "".join(f"<div class={rng.choice('abc') if rng.random() < .2 else 'abc'[j % 3]}>{tree(depth - 1, k)}</div>" for j in range(rng.randint(1, 3)))
    rows = [(f"h{k % 2}", "<div class=q>same</div>" * 2 + tree(6, k) + "<p><i><b><u>deep</u></b></i></p>") for k in range(30)]
    df = spark.createDataFrame(rows + rows[:5], "host string, html string").repartition(4)
    nodes = html_main.style_nodes(df)
    got = {(r.host, r.path): r for r in html_main.importance(nodes).collect()}
    low = {(r.host, r.path): r.low for r in html_main.branches(html_main.importance(nodes), Scratch(spark, "t-branches")).collect()}
    for site in ("h0", "h1"):
        want = brute_importance([h for s, h in rows if s == site])
        assert {p for s, p in got if s == site} == set(want)
        for path, (n, h) in want.items():
            assert got[site, path].n == n and abs(got[site, path].h - h) < 1e-9
        below = {}
        for path in want:
            at = path
            while at:
                below.setdefault(at, []).append(want[path][1])
                at = got[site, at].parent
        assert {p: low[site, p] for p in want} == {p: max(below[p]) < html_main.LOW for p in want}
        assert any(low[site, p] for p in want) and not all(low[site, p] for p in want)
    assert html_main.branches(html_main.importance(html_main.style_nodes(df.limit(0))), Scratch(spark, "t-none")).count() == 0


def test_site_branches_that_repeat_are_removed(spark):
    """No tag or class says so: only the site's style tree does."""
    pages = [(k, f"http://a.example/{k}", f"<body><div class=x1><span>Our shop, since 1990</span></div>"
              f"<div class=x2><p>Story {k} {k * 7}</p><p>Shared end.</p></div></body>") for k in range(12)]
    pages += [(100 + k, f"http://b.example/{k}", pages[0][2]) for k in range(12)]       # copies of one page: no evidence
    pages += [(200, None, None), (201, "x", ""), (202, "http://a.example/q", "<p>lone</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("low", F.lit(2))
    got = {r.page_id: r for r in html_main.main_text(df).collect()}
    assert got[3].text == "Story 3 21 Shared end." and got[3].low_branches > 0
    assert got[101].text == "Our shop, since 1990 Story 0 0 Shared end."
    assert (got[200].text, got[201].text, got[202].text) == ("", "", "lone")
    assert all(r.n_chars == len(r.text) for r in got.values()) and len(got) == len(pages)
    assert html_main.main_text(df.limit(0)).count() == 0


def test_the_style_tree_counts_inside_and_beside_articles(spark):
    """A box that repeats in every article goes, a title that repeats stays;
    a story beside teasers in <article> is content."""
    pages = [(k, f"http://a.example/{k}", f"<body><article><h1>Daily news</h1><p>Story {k} {k * 7}</p>"
              f"<div class=q7><h3>Like it?</h3><p>Get our letter</p></div></article></body>") for k in range(12)]
    pages += [(100 + k, f"http://b.example/{k}", f"<body><div class=post><p>A long story of {k} and {k * 3} words</p></div>"
               f"<article><a href=/x>Teaser {k} with many more words than all of the story beside it</a> New</article></body>") for k in range(12)]
    pages += [(200, "http://c.example/", pages[15][2])]  # a lone page: the tag decides
    got = {r.page_id: r.text for r in html_main.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[3] == "Daily news Story 3 21"
    assert got[103].startswith("A long story of 3 and 9 words")
    assert got[200].startswith("Teaser 3")


# ---------------------------------------------------------------- embeddings

def brute_links(rows, cosine):
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fine.setdefault(i, []).append(np.array(v) / np.linalg.norm(v))
    flat = [(i, v) for i, vs in fine.items() for v in vs]
    up, links = {i: i for i, _ in flat}, Counter()
    for a, (i, v) in enumerate(flat):
        for j, u in flat[:a]:
            if v @ u >= cosine:
                links[i] += 1
                links[j] += 1
                x, y = i, j
                while up[x] != x:
                    x = up[x]
                while up[y] != y:
                    y = up[y]
                up[max(x, y)] = min(x, y)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    return {i: (links[i], find(i) if i in up else i) for i, _ in rows}


def test_forest_finds_all_links(spark, monkeypatch):
    monkeypatch.setattr(forest, "LEAF", 40)   # several levels and blocks on a small table
    monkeypatch.setattr(forest, "BLOCK", 24)
    rng = np.random.default_rng(5)
    rows, k = [], 0
    for size in (1,) * 150 + (2, 3, 5, 90):   # a crowd of 90, larger than a leaf
        c = rng.normal(size=16)
        for _ in range(size):
            rows.append((k, (c + rng.normal(size=16) * (0.12 if size > 1 else 0)).tolist()))
            k += 1
    same = rows[0][1]
    rows += [(1000 + j, same) for j in range(30)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] + [1.0] * 15),
                                                     (2003, [1.0, None] + [1.0] * 14), (2004, []), (2005, [float("inf")] * 16),
                                                     (2006, [x * 1e-3 for x in same])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, hash int, weight int").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in forest.near_vectors(df).collect()}
    want = brute_links(rows, 0.95)
    found, there = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert found >= 0.99 * there and all(got[i][0] <= want[i][0] for i in want)
    if found == there:
        assert got == want
    assert forest.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("depth", [0, 2, 11, 21])
def test_pairs_at_the_threshold_share_leaves(depth):
    """Recall of pairs at cosine 0.951 in forests as deep as for 1.6 * 10^9 vectors."""
    rng = np.random.default_rng(depth)
    x = rng.normal(size=(20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    made = forest.Forest(x, forest.LEAF << depth, 0.95)
    a, n = x[:800], rng.normal(size=(800, 64))
    n -= (n * a).sum(axis=1, keepdims=True) * a
    b = 0.951 * a + np.sqrt(1 - 0.951 ** 2) * n / np.linalg.norm(n, axis=1, keepdims=True)
    met = [set() for _ in a]
    for r, code in zip(*made.leaves(a)):
        met[r].add(code)
    both = {r for r, code in zip(*made.leaves(b)) if code in met[r]}
    assert len(both) >= 0.99 * len(a)
    assert made.trees == 1 if depth == 0 else forest.FEWEST <= made.trees <= forest.TREES


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 60)] + [(100, 101), (101, 100), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in components(edges, Scratch(spark, "t")).collect()}
    assert got == {**{k: 1 for k in range(2, 61)}, 101: 100}


# ---------------------------------------------------------------- conversations

def test_chat_round_trip(spark):
    import random
    rng = random.Random(2)
    bits = ["\\", "<", "|im_end|>", "<|im_end|>", "[INST]", "a", "</s>", "\n", "é", "$1", "<s>", "<<SYS>>", "[/INST]", "[", "<|im_sep|>", ""]
    rows = [(i, k, rng.choice(["user", "assistant", "x<|im_sep|>", None]), rng.choice([None, "".join(rng.choices(bits, k=9))]), 1, "y")
            for i in range(150) for k in range(rng.randint(1, 5))]
    rows += [(None, None, None, None, 1, "y"), (500, 1, "assistant", "z" * 100_000, 1, "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, at int, turns string").repartition(7)
    made = chat.format_conversations(df)
    back = {r.conv_id: [(t.role, t.text) for t in r.p] for r in made.select("conv_id", chat.parsed().alias("p")).collect()}
    want: dict = {}
    for i, k, r, t, *_ in rows:
        want.setdefault(i, []).append((r or "", t or ""))
    assert back == want
    # one example per assistant turn; context and target are the text up to its end
    texts = {r.conv_id: r.formatted for r in made.collect()}
    seen = Counter()
    for r in chat.example_texts(made).collect():
        assert texts[r.conv_id].startswith(r.context + r.target)
        assert r.context.endswith(chat.SEP) and r.context.count(chat.START) == r.target_turn + 1
        seen[r.conv_id] += 1
    assert seen == Counter(i for i, _, r, *_ in rows if r == "assistant")
    for r in chat.expand(made).collect():
        at = r.context_chars
        assert texts[r.conv_id][at:at + len(r.target)] == r.target and texts[r.conv_id][:at].endswith(chat.SEP)
    for r in chat.digests(made).collect():
        loss = "".join(t for a, t in want[r.conv_id] if a == "assistant")
        turns = "".join(f"{a}\n{t}\n" for a, t in want[r.conv_id])
        assert (r.loss_chars, r.loss_sha256, r.turns_sha256) == (
            len(loss), hashlib.sha256(loss.encode()).hexdigest(), hashlib.sha256(turns.encode()).hexdigest())
    assert chat.format_conversations(df.limit(0)).count() == 0


# ---------------------------------------------------------------- personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(d[::-1])) % 10 == 0


def brute_spans(t):
    out = []
    for rank, (kind, p) in enumerate(BASE.items()):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and max(map(int, m[0].split("."))) > 255) or (kind == "card" and not (14 <= len(d) <= 19 and luhn(d))) \
                    or (kind == "phone" and not 10 <= len(d) <= 15):
                continue
            out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


@pytest.fixture(scope="module")
def private():
    import random
    rng = random.Random(6)
    bits = ["a", "b.c", "@", "x@y.z", ".", "1", "22", "4", "255", "256", " ", "-", "+", "(", ")", "_x@d.e", "4111111111111111", "+1 (234) 555-1234",
            "é", "🙂", "\n", "1.2.3.4", "4111 1111 1111 1111", "001.002.3.04"]
    rows = [(k, "".join(rng.choices(bits, k=rng.randint(0, 25)))) for k in range(600)]
    rows += [(5000 + k, f"clean words here {k} and 12 more of them, 3.5 or 2024-01-02") for k in range(50)]
    rows += [(6000 + k, f'my token = "a{k:02d}f9e8d7c6b5a4938271605f" ok, mail me: joe{k}@mail.com please') for k in range(30)]
    rows += [(7000, "1" * 50_000), (7001, "1.1." * 3000), (7002, "a@" + "b." * 20_000), (7003, "a" * 100_000 + "@b.c"), (7004, "1 " * 30_000),
             (7005, None), (7006, ""), (None, "x@y.zz"), (600, "same"), (600, "same")]
    return rows


def test_personal_data(spark, private):
    df = spark.createDataFrame([(*r, 3, "x") for r in private], "doc_id long, text string, email int, spans string").repartition(6)
    out = pii.detect(df.select("doc_id", pii.text_column(df)), keep_text=True)
    got = out.select("doc_id", "text", pii._joined(F.filter("spans", lambda s: s["base"])).alias("base"), pii._joined(F.col("spans")).alias("all"),
                     pii.masked("text", "spans").alias("masked")).collect()
    assert len(got) == len(private)
    for r in got:
        assert r.base == brute_spans(r.text)
        assert set(r.base.split(",")) <= set(r.all.split(",")) | {""}
        if r.doc_id and 5000 <= r.doc_id < 6000:
            assert r.all == "" and r.masked == r.text
        if r.doc_id and 6000 <= r.doc_id < 7000:
            assert "secret:" in r.all and r.masked == 'my token = "<SECRET>" ok, mail me: <EMAIL> please'
    done = pii.without_personal_data(df)
    assert done.columns == df.columns and {(r.email, r.spans) for r in done.collect()} == {(3, "x")}
    assert pii.without_personal_data(df.limit(0)).count() == 0


def test_long_secrets_are_masked_whole(spark):
    rows = [(k, f'my token = "a{k:02d}f9e8d7c6b5a4938271605f" ok') for k in range(30)]
    rows += [(100 + n, 'my token = "' + "aB3x" * (n // 4) + '" ok') for n in (600, 2000, 1_000_000)]
    out = pii.detect(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=True)
    assert {r[0] for r in out.select(pii.masked("text", "spans")).collect()} == {'my token = "<SECRET>" ok'}


def labelled_spans():
    """(text, the added span as kind:value, or None for a decoy of its kind)."""
    import random
    rng = random.Random(12)
    rows = []
    for k in range(120):
        n3, n4 = rng.randint(200, 999), rng.randint(1000, 9999)
        name = rng.choice(["ann", "bob.lee", "q" * 90])
        rows += [(f"my email is {name}{k} (at) mail{k % 7} (dot) com ok", f"email:{name}{k} (at) mail{k % 7} (dot) com"),
                 (f"send mail: {name}{k} [at] site.org ok", f"email:{name}{k} [at] site.org"),
                 (f"we met{k} (at) noon{k} (dot) we{k}x then", None),
                 (f"'api_key': 'k{n4}Zq{n3}fX{n4}bb{k}'", f"secret:k{n4}Zq{n3}fX{n4}bb{k}"),
                 (f"password = 'change me{k}'", None), (f"write to joe{k}@mail.com", None), (f"call +1 (234) {n3}-{n4} now", None)]
    return rows


def test_added_spans_of_a_labelled_fixture(spark):
    rows = labelled_spans()
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")
    right, wrong, missed = Counter(), Counter(), Counter()
    for r in pii.detect(df, keep_text=True).collect():
        want = rows[r.doc_id][1]
        got = {f"{s.kind.rstrip('?')}:{r.text[s.start:s.end]}" for s in r.spans if not s.base}
        if want:
            (right if want in got else missed)[want.split(":")[0]] += 1
        for s in got - {want}:
            wrong[s.split(":")[0]] += 1
    for kind in ("email", "secret"):
        assert right[kind] >= 0.95 * (right[kind] + missed[kind]) and wrong[kind] <= 0.05 * right[kind], (kind, right, wrong, missed)


def test_spans_of_one_text_take_linear_time(spark):
    import time
    took = {}
    for n in (100, 4000, 16_000):  # the first compiles
        text = " ".join(f"mail joe{k}@mail.com now 4111111111111111 (at)" for k in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        begin = time.time()
        (row,) = pii.without_personal_data(df).collect()
        took[n] = time.time() - begin
        assert row.text == " ".join(["mail <EMAIL> now <CARD> (at)"] * n)
    assert took[16_000] <= 5 * took[4000], took


def test_running_arrays(spark):
    import random
    from tessera.llm import arrays
    rng = random.Random(3)
    rows = [([rng.randint(0, 9) for _ in range(n)],) for n in (0, 1, 63, 64, 65, 128, 4096, 4100, 9000)]
    text = "".join(rng.choice("aé🙂\n") for _ in range(1500))
    df = spark.createDataFrame(rows, "v array<int>")
    for (v,), r in zip(rows, df.select("v", arrays.running(F.col("v"), arrays.add).alias("s"), arrays.running(F.col("v"), arrays.largest).alias("m"),
                                       arrays.count_below(F.array_sort("v"), F.lit(5)).alias("n")).collect()):
        assert r.v == v and r.s == [sum(v[:k]) for k in range(len(v))] if len(v) < 200 else r.s[-1] == sum(v[:-1]) and len(r.s) == len(v)
        assert r.m == [max(v[:k], default=0) for k in range(len(v))] and r.n == sum(x < 5 for x in v)
    spots = [(text, a, n) for a in (0, 1, 255, 256, 257, 1499, 1500) for n in (0, 1, 255, 256, 700) if a + n <= 1500]
    df = spark.createDataFrame(spots, "t string, a int, n int")
    got = df.select("a", "n", arrays.cut(arrays.chunks(F.col("t")), F.col("a"), F.col("n")).alias("c")).collect()
    assert all(r.c == text[r.a:r.a + r.n] for r in got)


def test_reliabilities_are_recovered():
    """Votes drawn from labelers of known accuracy; EM ranks them."""
    rng = np.random.default_rng(3)
    right = (0.95, 0.9, 0.75, 0.6)
    counts = Counter()
    for _ in range(4000):
        truth = 1 if rng.random() < 0.6 else -1
        counts[tuple(truth if rng.random() < p else -truth for p in right)] += 1
    rows = [{"kind": "ip", "size": 3, "digits": 2, "n": n, **dict(zip(pii.LABELERS, v))} for v, n in counts.items()]
    model = pii.Reliability(rows)
    assert model.table["ip", (1, 1, 1, 1)] > 0.99 and model.table["ip", (-1, -1, -1, -1)] < 0.01
    assert model.table["ip", (1, 1, -1, -1)] > 0.5 > model.table["ip", (-1, -1, 1, 1)]


# ---------------------------------------------------------------- registry and pipeline

def test_registered_names():
    assert sorted(int(k[2:].split("_")[0]) for k in registry.queries()) == list(range(1, 14))


def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    from tests.conftest import SMALL
    from tests.llm.test_text_operators import W, brute_repeats, brute_components, measures, shingle_set
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    keep = Scratch(spark, "t")
    out, names = [docs], [n for n, _ in cp.STAGES]
    for name, stage in cp.STAGES[:-1]:
        out.append(keep.save(stage(spark, out[-1], SMALL), "stage"))
        assert out[-1].columns == docs.columns, name
    text = [{r.doc_id: r.text for r in d.collect()} for d in out]
    passed = {i for i, t in text[0].items() if (m := measures(t))[0] >= 50 and 100 * m[5] <= 50 * m[0]}
    assert set(text[1]) <= passed
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    judged = [i for i in labels if i in passed]
    assert sum((i in text[1]) == bool(labels[i]) for i in judged) >= 0.98 * len(judged)
    comp = brute_components({i: shingle_set(t, 5) for i, t in text[1].items()}, 80)
    assert set(text[2]) == set(comp.values())
    want = brute_repeats([(i, t) for i, t in text[2].items()], 20)
    assert {i: hashlib.sha256(" ".join(W.findall(t)).encode()).hexdigest() for i, t in text[3].items()} == {i: w[2] for i, w in want.items()}
    assert set(text[4]) == set(text[3]) and not any(brute_spans(t) for t in text[4].values() if "<" in t and "@" in t)
    pieces = cp.STAGES[-1][1](spark, out[-1], SMALL)
    assert {r.doc_id for r in pieces.collect()} == set(text[4]) and names[-1] == "packing"
