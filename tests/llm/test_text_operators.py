"""Quality rules, MinHash, substring and packing against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import minhash, packing, quality_rules, substring
from tessera.llm.scratch import Scratch
from tessera.llm.words import find_words, mix, windows
from tests.llm.conftest import prose

W = re.compile(r"[^\x20\x09-\x0D]+")


def measures(t):
    w = W.findall(t or "")
    c = Counter(zip(w, w[1:], w[2:]))
    hit = [False] * len(w)
    for i in range(len(w) - 2):
        if c[tuple(w[i:i + 3])] > 1:
            hit[i] = hit[i + 1] = hit[i + 2] = True
    lines = [x for x in (t or "").split("\n") if W.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines), len(lines) - len(set(lines)), sum(hit)


def test_quality_measures(docs, rows, spark):
    got = {r.doc_id: r for r in quality_rules.judge(docs, Scratch(spark, "t")).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        want = measures(t)
        assert tuple(got[i][k] for k in quality_rules.MEASURES) == want
        assert got[i].base_failed == (want[0] < 50 or 100 * want[5] > 50 * want[0])
        assert not (got[i].base_failed and got[i].kept)


def test_quality_thresholds_follow_their_group(spark):
    """A source where symbols are normal keeps them; elsewhere they fail."""
    import random
    from tests.llm.conftest import prose
    rng = random.Random(4)
    rows = [(k, prose(rng, 80) + " #" * (20 + k % 5 if k % 2 else 0), "en", "code" if k % 2 else "news") for k in range(160)]
    rows.append((999, prose(rng, 80) + " #" * 30, "en", "news"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(df, Scratch(spark, "t")).collect()}
    assert not kept.pop(999) and all(kept.values())
    # sketches of parts merge to the corpus sketch: a tiny group takes its language's bounds
    small = quality_rules.thresholds(quality_rules.features(df), min_rows=1000).select("t").distinct().count()
    assert small == 1


def exact_verdict(found, t):
    """(kept, near): the rules by plain arithmetic; near a bound sketches may differ."""
    kept, near = True, False
    for k, (count, base, clump, _) in quality_rules.RULES.items():
        n, size = found[count], found[base]
        for bound, sign in ((t[k][1], 1), (t[k][0], -1)):
            if sign < 0 and k not in quality_rules.TWO_SIDED:
                continue
            mean = max(bound * size, 0)
            limit = mean + sign * quality_rules.SIGMAS * (clump * mean + clump * clump) ** 0.5
            kept &= sign * n <= sign * limit
            near |= abs(n - limit) <= 0.02 * max(n, limit, 1)
    return kept, near


def test_quality_verdicts_equal_exact_quantiles(spark):
    """All texts of sf0.01 and a group below the row limit, judged by sorting."""
    from tests.conftest import SMALL
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source")
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 97 == 0, "rare").otherwise("all")).union(
        spark.createDataFrame([(-1, "short", "xx", "y"), (-2, None, None, None)], docs.schema))
    rows = quality_rules.judge(docs, Scratch(spark, "t")).collect()
    passed = [r for r in rows if not r.base_failed]

    def bounds(some):
        out = {}
        for k, (count, base, _, at) in quality_rules.RULES.items():
            low, high = np.quantile([r[count] / max(r[base], 1) for r in some], at, method="inverted_cdf")
            out[k] = (low - quality_rules.SPREADS * (high - low), high + quality_rules.SPREADS * (high - low))
        return out
    made = {}
    for r in passed:
        levels = ([x for x in passed if (x.lang, x.source) == (r.lang, r.source)], [x for x in passed if x.lang == r.lang], passed)
        at = next((k for k, some in enumerate(levels) if len(some) >= quality_rules.MIN_ROWS), 2)
        key = (at, *(r.lang, r.source)[:2 - at])
        if key not in made:
            made[key] = bounds(levels[at])
        kept, near = exact_verdict(r, made[key])
        assert near or r.kept == kept, r.doc_id
    assert len(made) > 2 and len({tuple(v["word_chars"]) for v in made.values()}) > 2
    assert not any(r.kept for r in rows if r.base_failed)


def test_quality_rules_without_good_texts(spark, empty):
    assert quality_rules.judge(empty, Scratch(spark, "t")).count() == 0
    one = spark.createDataFrame([(1, "too short", None, "a"), (1, "too short", None, "a")], "doc_id long, text string, lang string, source string")
    assert [r.kept for r in quality_rules.judge(one, Scratch(spark, "t")).collect()] == [False, False]


def test_quality_word_length_decides(spark):
    """A source of long words keeps them; among common words they fail."""
    rng = random.Random(8)

    def text(length):
        return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(length - 1, length + 1))) for _ in range(120))
    rows = [(k, text(9 if k % 2 else 5), "en", "terms" if k % 2 else "news") for k in range(160)] + [(999, text(9), "en", "news")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(df, Scratch(spark, "t")).collect()}
    assert not kept.pop(999) and all(kept.values())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t#é", max_size=40), min_size=1, max_size=6))
def test_measure_property(texts):
    import pyarrow as pa
    got = quality_rules.measure(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        assert tuple(int(got[m][k]) for m in quality_rules.MEASURES) == measures(t)


def shingle_set(t, n):
    w = W.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def find(up, x):
    while up[x] != x:
        x = up[x]
    return x


def brute_components(sets, percent):
    up = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(up, a), find(up, b)
                up[max(x, y)] = min(x, y)
    return {i: find(up, i) for i in ids}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_minhash_components(docs, rows, size, percent):
    sets = {i: shingle_set(t, size) for i, t, *_ in rows}
    want = brute_components(sets, percent)
    got = {r.doc_id: r for r in minhash.near_duplicates(docs, size, percent).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == \
        {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_minhash_in_blocks_and_chains(spark, monkeypatch):
    """A group far larger than a block, whose members link only in a chain."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    words = [f"w{k}" for k in range(140)]
    rows = [(100 + k, " ".join(words[k:k + 60])) for k in range(0, 80, 2)] + [(7, None), (None, "a b c"), (None, "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(df, 3, 85).collect()
    assert Counter(r.component_id for r in got) == {100: 40, 7: 1, None: 2}


def test_stage_forms_keep_columns(docs, rows, spark):
    good = quality_rules.good_documents(docs, Scratch(spark, "t"))
    assert good.columns == docs.columns and {r.key for r in good.collect()} == {"k"}
    one = minhash.distinct_documents(docs.withColumnRenamed("key", "kept_id"))
    sets = {i: shingle_set(t, 5) for i, t, *_ in rows}
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(brute_components(sets, 80).values()))


def test_minhash_of_shared_ids(spark):
    """Rows of one doc_id with different texts: each belongs to its own group;
    of repeated rows and of each group one row stays."""
    rng = random.Random(31)
    a, b, c = (prose(rng, 150) for _ in range(3))
    near = lambda t: t.replace(" ", " changed ", 1)
    rows = [(1, a), (1, b), (2, near(b)), (3, near(a)), (5, c), (5, c), (6, c), (7, None), (7, ""), (7, ""), (None, a), (None, a)]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, class int").repartition(3)
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in minhash.near_duplicates(df, 3, 85).collect())
    assert got == [(0, 0, True), (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (5, 5, True), (5, 5, True),
                   (6, 5, False), (7, 7, True), (7, 7, True), (7, 7, True)]
    stay = minhash.distinct_documents(df, 3, 85)
    assert stay.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in stay.collect()) == sorted([(0, a), (0, a), (1, a), (1, b), (5, c), (7, "")])


def test_components_of_hubs(spark, monkeypatch):
    """Hubs take the way of their own and give the same components."""
    from tessera.llm import components as comp
    monkeypatch.setattr(comp, "HUB", 3)
    scratch = Scratch(spark, "t-hubs")
    edges = [(0, k) for k in range(1, 40)] + [(39, 50), (50, 51), (60, 61), (61, 62)] + [(100, k) for k in range(70, 99)] + [(98, 200)]
    df = scratch.save(spark.createDataFrame(edges, "a long, b long"), "edges")
    got = {r.node: r.component for r in comp.components(df, scratch).collect()}
    assert got == {**{k: 0 for k in [*range(1, 40), 50, 51]}, 61: 60, 62: 60, **{k: 70 for k in [*range(71, 99), 100, 200]}}


def test_minhash_empty(empty):
    assert minhash.near_duplicates(empty, 3, 85).count() == 0
    assert minhash.distinct_documents(empty).columns == empty.columns


def brute_repeats(rows, width):
    seen, out = set(), {}
    for i, t, *_ in sorted(rows):
        w = W.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            x = tuple(w[k:k + width])
            if x in seen:
                gone[k:k + width] = [True] * width
            seen.add(x)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substring(docs, rows):
    out, _ = substring.parse(docs)
    got = {r.id: (r.n_words, r.n_removed, r.sha.hex()) for r in out.collect()}
    assert got == brute_repeats(rows, 20)


def test_substring_rows_keep_their_columns(docs, rows, empty):
    out = substring.without_repeats(docs)
    assert out.columns == docs.columns
    want = brute_repeats(rows, 20)
    for r in out.collect():
        assert (r.id, r.no, r.row, r.start) == (5, "x", 3, 2)
        kept = " ".join(W.findall(r.text or ""))
        assert hashlib.sha256(kept.encode()).hexdigest() == want[r.doc_id][2]
    assert substring.without_repeats(empty).count() == 0


def test_factors_run_on_and_break_at_boundaries():
    ref, other = (1, 0), (2, 0)
    runs = [(0, 3, ref, 10), (3, 2, ref, 13), (5, 1, other, 0), (40, 1, ref, 50)]
    assert substring.factor(runs, 20) == [(0, 24, ref, 10), (5, 20, other, 0), (40, 20, ref, 50)]


def test_windows_that_agree_in_half_their_hash_are_no_repeat(spark):
    """Windows of one anchor, pairs of which share the upper 32 bits of their
    hashes: nothing repeats."""
    rest = " ".join([f"v{j}" for j in range(13)] + [f"s{61448 + j}" for j in range(6)])
    pairs = [(33713, 36248), (40003, 53892), (47520, 57821), (85330, 118553), (44801, 129907)]
    rows = [(k, f"w{i} {rest}") for k, i in enumerate(x for p in pairs for x in p)]
    w = find_words(pa.array([t for _, t in rows]))
    best, gram = substring.anchors(w, w.hashes(), 20)
    inside = substring.whole_windows(w, 20)
    upper = mix(windows(w.hashes(), 20)[inside]) >> np.uint64(32)
    assert (upper[::2] == upper[1::2]).all() and len(set(gram[best[inside]].tolist())) == 1
    out, _ = substring.parse(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.id: r.n_removed for r in out.collect()} == dict.fromkeys(range(len(rows)), 0)


def test_a_common_anchor_is_dealt_to_many_shards(docs, rows, spark, monkeypatch):
    """A passage that very many documents share: its windows, and those that
    straddle its edges, spread over shards that hold few of them each."""
    monkeypatch.setattr(substring, "SHARD", 8)
    shared = "the one passage that every site of this corpus prints below each of its own stories without any change to it".split()
    many = [(k, " ".join([f"a{k}x{j}" for j in range(25)] + shared + [f"b{k}x{j}" for j in range(25)])) for k in range(300)]
    found, first = [], substring.first_places
    monkeypatch.setattr(substring, "first_places", lambda df: (found.append(df), first(df))[1])
    out, _ = substring.parse(spark.createDataFrame(many, "doc_id long, text string"))
    assert {r.id: (r.n_words, r.n_removed, r.sha.hex()) for r in out.collect()} == brute_repeats(many, 20)
    held = {}  # distinct windows that a shard remembers
    for r in found[0].collect():
        held.setdefault((r.gram, r.shard), set()).update(r.windows[k:k + 8] for k in range(0, len(r.windows), 8))
    assert max(Counter(g for g, _ in held).values()) >= 16
    assert max(map(len, held.values())) <= 8 * 15
    out, _ = substring.parse(docs)
    assert {r.id: (r.n_words, r.n_removed, r.sha.hex()) for r in out.collect()} == brute_repeats(rows, 20)
    keys = [(r.gram, r.shard, r.id, r.no) for r in found[1].collect()]
    assert len(keys) == len(set(keys))  # a text that repeats a few words ships no row for each time


def encoded(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return {i: np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4") for i, x, *_ in rows}


def test_packing_covers_every_id_once(docs, rows):
    want, seqs, cover = encoded(rows), {}, {}
    for r in packing.pack_documents(docs, P.path("byte_bpe_50k.json")).collect():
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        cover.setdefault(r.doc_id, []).append((r.start, r.length))
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, ids in want.items():
        at = 0
        for s, n in sorted(cover[i]):
            assert s == at
            at += n
        assert at == len(ids)
    for pieces in seqs.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 2048 and at & (at - 1) == 0  # full, or a power of two: nothing is padded


def test_neighbours_share_rare_terms():
    docs = [np.array(x) for x in ([1, 2, 3], [1, 9, 9], [2, 3, 8], [7, 7, 7], [1, 5, 6])]
    index = packing.Bm25(docs)
    assert index.neighbours(0)[:2] == [0, 2] and 3 not in index.neighbours(0)
    assert packing.pack_shard([], 8) == []
    assert sorted(n for s in packing.pack_shard([np.arange(21)], 8) for *_, n in s) == [1, 4, 8, 8]


def test_packing_empty(empty):
    assert packing.pack_documents(empty, P.path("byte_bpe_50k.json")).count() == 0


def test_linked_texts_hashes_a_slice_at_a_time(monkeypatch):
    """A batch of many groups takes the working memory of one slice."""
    import numpy as np
    import pyarrow as pa
    from tessera.llm import minhash, words
    texts = [f"w{i} alpha beta gamma delta w{i % 7} omega" * 3 if i % 5 else None for i in range(400)] + ["", "one two"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    most, sets = [], minhash.shingle_sets
    monkeypatch.setattr(minhash, "shingle_sets", lambda t, size: (most.append(int(words.text_bytes(t)[1][-1])), sets(t, size))[1])
    monkeypatch.setattr(words.slices, "__defaults__", (2000,))
    got = minhash.sliced_sets(batch, 5)
    assert len(most) > 5 and max(most) <= 2000
    for a, b in zip(got, sets(batch.column("text"), 5)):
        assert np.array_equal(a, b)
    assert not len(minhash.sliced_sets(batch.slice(0, 0), 5)[0])
