"""URL rules, ranked search and centroid clustering against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm import centroids, ranked_search, url_rules

# ---------------------------------------------------------------- url rules


def split(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group(0)
    path = re.match(r"[^?#]*", rest[len(host):]).group(0)
    return "".join(c.lower() if c.isascii() else c for c in host), path


def brute_rule(host, path, rules):
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules
            if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return None, "allow"
    longest = max(fits)
    return longest[3], longest[4]


def many_urls(rng, n):
    labels, dirs = ["a", "b-c", "a1", "x", "é", ""], ["a", "aa", "b", "", "ä", "zz" * 50]
    out = []
    for _ in range(n):
        host = ".".join(rng.choice(labels) for _ in range(rng.randint(1, 5))) + rng.choice([".net", ".org", "net", ":80", "."])
        path = "".join("/" + rng.choice(dirs) for _ in range(rng.randint(0, 4)))
        out.append(rng.choice(["http", "HTTPS", ""]) + "://" + host.upper() + path + rng.choice(["", "?q=/a", "#/b", "?"]))
    return out + [None, "", "a.net/a", "://", "http://a.net", "http://a.net?/a", "x://y://z.net/a", "http://" + "a." * 3000 + "net/" + "a/" * 5000]


def many_rules(rng):
    hosts = ["net", "a.net", "b-c.a.net", "x.org", "org", "é.org", "a", "x.a.net:80", "", "a1.net."]
    paths = ["", "/", "/a", "/a/", "/aa", "/a/b", "/a/b/", "/b", "/ä", "/zz", "/a/b/aa/x"]
    return [(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(paths)) for _ in range(60)]


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_equal_trying_each(spark, seed):
    rng = random.Random(seed)
    urls = many_urls(rng, 300) + ["http://a.net/a/b"] * 150 + [f"http://hot.a.net/a/{i:04d}" for i in range(200)]
    rows = [(i if i % 7 else None, u, "own", i) for i, u in enumerate(urls)]
    rules = many_rules(rng)
    df = spark.createDataFrame(rows, "page_id long, url string, host string, row long").repartition(4)
    out = url_rules.judge(df, spark.createDataFrame(rules, "verdict string, host string, path string"), keep=("page_id", "url", "host", "row"))
    got = sorted(((r.whole.row, r.whole.page_id, r.whole.url, r.whole.host, r.host, r.path, r.rule, r.verdict) for r in out.collect()))
    want = [(i, p, u, "own", *split(u), *brute_rule(*split(u), rules)) for p, u, _, i in rows]
    assert got == sorted(want)


def test_rules_spread_over_ranges():
    """A host's ranges get only the rules whose paths they meet, a rule of
    many ranges reaches all of them."""
    cuts = [("net.a.", "/b", 3), ("net.a.", "/f", 9), ("net.a.", "/f/x", 2), ("net.b.", "", 0), ("org.", "/", 5)]
    assert url_rules._meets(cuts, "net.", "/") == [0, 1, 2, 3, 4]
    assert url_rules._meets(cuts, "net.a.", "/c") == [0, 1, 3]  # ranges 0 and 3 hold other hosts too
    assert url_rules._meets(cuts, "net.a.", "/f") == [0, 1, 2, 3]
    assert url_rules._meets(cuts, "net.b.", "/a") == [3, 4]  # the cut between them lies at the host's beginning
    assert url_rules._meets(cuts, "", "/") == list(range(6))
    assert url_rules._meets([], "x.", "/") == [0]


def test_rules_of_empty_tables(spark):
    none = spark.createDataFrame([], "verdict string, host string, path string")
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r)[1:] for r in url_rules.judge(df, none, keep=("page_id",)).collect()] == [("a.net", "/", None, "allow")]
    some = spark.createDataFrame([("block", None, None), ("allow", "A.net", None)], none.schema)
    assert url_rules.judge(df, some).first().rule == "a.net"
    assert url_rules.judge(df.limit(0), some).count() == 0
    assert url_rules.judge(df, some, default="block").first().verdict == "allow"


# ---------------------------------------------------------------- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_rank(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    total, length = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in counts:
            m = 50 + (50 * n * total) // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is not None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return out


@pytest.mark.parametrize("k", [3, 50])
def test_ranks_equal_scoring_all(spark, docs, rows, k, monkeypatch):
    monkeypatch.setattr(ranked_search, "QUERY_BYTES", 2000)  # several blocks of queries
    texts = [r[1] for r in rows]
    items = [(i, t) for i, t in enumerate(t[:400] for t in texts[:12] if t)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, "ALPHA1, alpha1; é Ü"), (None, "one two"), (53, "one"), (53, "one")]
    df = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as rank", "2 as q")
    again = docs.union(docs.where("doc_id % 5 = 0")).union(docs.where("doc_id % 11 = 0").selectExpr(
        "cast(null as long) as doc_id", *[c for c in docs.columns if c != "doc_id"]))
    got = ranked_search.rank(again, df, k).collect()
    full = rows + [r for r in rows if r[0] % 5 == 0] + [(None, *r[1:]) for r in rows if r[0] % 11 == 0]
    want = brute_rank([r[:2] for r in full], items, k)
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("docs_", [1, 7, 1000])
def test_small_shards_give_the_same(spark, docs, docs_, monkeypatch):
    """Tasks see the rows in many shards, or one document in several postings."""
    rng = random.Random(docs_)
    n, words = 600, 40
    doc, term, tf = zip(*((d, t, rng.randint(1, 3)) for d in range(n) for t in rng.sample(range(words), rng.randint(1, 30))))
    doc, term, tf = map(np.array, (doc, term, tf))
    stats = ranked_search.Statistics(n, len(doc), np.array([rng.randint(0, 50) * 100 for _ in range(words)]))
    impact = stats.impact(term, tf, stats.share(np.bincount(doc, minlength=n)[doc]))
    some = impact > 0
    for query in ([0], [1, 5, 9, 30], list(range(words))):
        full = np.zeros(n, np.int64)
        inside = np.isin(term, query)
        np.add.at(full, doc[inside], impact[inside])
        want = sorted(((-s, d) for d, s in enumerate(full) if s > 0))[:10]
        got = []
        for lo in range(0, n, docs_):
            part = some & (doc >= lo) & (doc < lo + docs_)
            shard = ranked_search.Shard(doc[part] - lo, term[part], impact[part], docs_, words)
            floor = -got[-1][0] if len(got) == 10 else 1
            found, score = shard.top(np.array(query), 10, floor)
            got = sorted(got + [(-s, d + lo) for d, s in zip(found.tolist(), score.tolist())])[:10]
        assert got == want


def test_lists_are_not_read_to_their_end():
    """The best documents are told apart before the lists end."""
    n = 20_000
    doc = np.concatenate([np.arange(n), np.arange(n)])
    term = np.repeat([0, 1], n)
    impact = np.concatenate([np.arange(n, 0, -1) * 1000, np.arange(n, 0, -1) * 900])
    read = []
    found, score = ranked_search.Shard(doc, term, impact, n, 2).top(np.array([0, 1]), 5, 1, read)
    assert sorted(found[np.argsort(-score)][:5]) == [0, 1, 2, 3, 4] and read[0].max() < n // 10


def test_search_of_empty_tables(spark, docs, empty):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert ranked_search.rank(empty, items).count() == 0
    assert ranked_search.rank(docs, items.limit(0)).count() == 0
    assert ranked_search.rank(docs.where("text is null"), items).count() == 0
    assert ranked_search.rank(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


# ---------------------------------------------------------------- centroids

def brute_cluster(rows, k, rounds, dim, scale, seed):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    mark = [(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), i is not None, i or 0, v) for i, v in kept]
    points = [m[3] for m in sorted(mark)[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        points = [[sum(col) // len(groups[c]) for col in zip(*groups[c])] if c in groups else p for c, p in enumerate(points)]
    return [(i, nearest(v)[1], nearest(v)[0], points[nearest(v)[1]]) for i, v in kept]


@pytest.mark.parametrize("seed", [3, 4])
def test_clusters_equal_all_distances(spark, seed):
    rng = random.Random(seed)
    mids = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(mids)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)] + [(7, [round(x) / 2 for x in rows[k][1]]) for k in range(40)]
    rows += [(300, None), (301, []), (302, [0.0] * 5), (303, [0.0] * 7), (304, [float("nan")] + [0.0] * 5), (305, [float("inf")] * 6),
             (306, [None] + [0.0] * 5), (None, [0.25] * 6), (307, [0.0] * 6), (308, [-0.0] * 6), (309, [3e3, -3e3, 0.0, 1e-9, -1e-9, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as cluster", "2 as x", "3 as c").repartition(5)
    got = centroids.cluster(df, 9, 4, 6, 256, seed).collect()
    want = brute_cluster(rows, 9, 4, 6, 256, seed)
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(((r.vec_id, r.cluster, r.distance, r.centroid) for r in got), key=key) == sorted(want, key=key)
    sums = Counter()
    for _, c, d, _ in want:
        sums[c] += d
    assert all(r.cluster_inertia == sums[r.cluster] and r.inertia == sum(sums.values()) for r in got)


def test_walk_finds_the_nearest_and_stops_early():
    rng = np.random.default_rng(5)
    points = rng.integers(-40, 40, (30, 4))
    points[7] = points[3]
    x = np.concatenate([rng.integers(-60, 60, (500, 4)), points, points[:5] + 1])
    which, dist, steps = centroids.SortedCentroids(points).nearest(x)
    full = ((x[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (dist == full.min(axis=1)).all() and (which == full.argmin(axis=1)).all()
    assert centroids.SortedCentroids(points).nearest(points[:1])[2] < 30 and steps <= 30
    assert centroids.SortedCentroids(points).nearest(x[:0])[0].size == 0


def test_clusters_of_empty_tables(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1e300, -1e300])], "vec_id long, embedding array<double>")
    assert centroids.cluster(df.limit(0), dim=2).count() == 0
    assert centroids.cluster(df, dim=3).count() == 0
    got = centroids.cluster(df, k=40, dim=2).collect()
    assert len(got) == 3 and all(r.distance == 0 for r in got) and len({r.cluster for r in got}) == 2
