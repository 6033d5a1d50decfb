"""Quality rules with adaptive thresholds (operator 5).

Per text: words, code points in words, symbols, repeated lines, words in
repeated 3-word windows.  Their ratios go into KLL quantile sketches, one set
per (lang, source); Spark builds them partially on each task, so a hot source
shuffles a few KB a task.  The sketches of the sources of a language are then
merged into one for the language, and those into one for the corpus.  A group
with fewer than ``min_rows`` texts takes the thresholds of its language, a
language with too few those of the corpus.

Only texts that pass the base rules are sketched.  A measure counts events
(symbols, words in repeated windows, repeated lines, characters) against a base
(words or lines).  Its group's highest rate lies ``SPREADS`` quantile ranges
above the upper of the two quantiles: the middle half for symbols and word
lengths, median to upper decile for repeats, which most texts lack.  A text
fails if its count is more than chance adds at that rate: ``SIGMAS`` deviations
of a count that comes in clumps (a repeated window covers six words), so a long
text is held to the rate and a short one may hold a few events.  The mean word
length also fails below the mirrored bound.  No cutoff is fixed.  A text is kept
if it passes the base rules and every threshold.

A null or empty text has no words and fails the base rules.  Null lang or
source form groups of their own; repeated rows each count and get their own
row; ties at a threshold are kept; an empty table gives no rows.  Very long
texts are measured whole; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch
from tessera.llm.words import find_words, segment_hash, shingles, slices, text_column

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

#: rule -> (count, base, clump, the two quantiles whose range is the spread)
RULES = {"symbols": ("n_symbols", "n_words", 1, (0.25, 0.75)), "repeats": ("n_repeat_words", "n_words", 6, (0.5, 0.9)),
         "dup_lines": ("n_dup_lines", "n_lines", 1, (0.5, 0.9)), "word_chars": ("word_chars", "n_words", 1, (0.25, 0.75))}
TWO_SIDED = ("word_chars",)
SPREADS, SIGMAS = 6.0, 6.0
MIN_ROWS = 50
SKETCH_K = 400
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text, by MEASURES."""
    w = find_words(texts)
    n = len(w.off) - 1
    h = w.hashes()
    chars = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    marks = np.concatenate([[0], np.cumsum(SYMBOLS[w.data])])
    per_word = chars[w.end] - chars[w.start]
    out = {"n_words": w.counts, "word_chars": np.bincount(w.doc, per_word, n).astype(np.int64),
           "n_symbols": marks[w.off[1:]] - marks[w.off[:-1]]}

    # Lines with a word: between line feeds and text ends.
    cut = np.zeros(len(w.data) + 1, bool)
    cut[np.flatnonzero(w.data == 10) + 1] = True
    cut[w.off] = True
    begin = np.flatnonzero(cut[:-1])
    end = np.append(begin[1:], len(w.data)) if len(begin) else begin
    # the line's own feed is no part of it: the last line of a text has none
    end = end - (w.data[end - 1] == 10) if len(end) else end
    has = np.searchsorted(w.start, end) > np.searchsorted(w.start, begin)
    begin, end = begin[has], end[has]
    doc = np.searchsorted(w.off, begin, side="right") - 1
    line = segment_hash(w.data, begin, end)
    out["n_lines"] = np.bincount(doc, minlength=n)
    key = np.unique(np.stack([doc.astype(np.uint64), line]), axis=1)[0].astype(np.int64) if len(doc) else doc
    out["n_dup_lines"] = out["n_lines"] - np.bincount(key, minlength=n)

    out["n_repeat_words"] = np.zeros(n, np.int64)
    sdoc, s = shingles(w, h, 3)
    if len(s):
        at = np.flatnonzero(w.doc[:len(h) - 2] == w.doc[2:])
        order = np.lexsort((s, sdoc))
        same = (s[order][1:] == s[order][:-1]) & (sdoc[order][1:] == sdoc[order][:-1])
        often = np.zeros(len(s), bool)
        often[order[1:][same]] = often[order[:-1][same]] = True
        covered = np.zeros(len(h), bool)
        for k in range(3):
            covered[at[often] + k] = True
        out["n_repeat_words"] = np.bincount(w.doc, covered, n).astype(np.int64)
    return out


def features(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the measures of every text; ``key`` tells rows
    of one doc_id apart by their text."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                m = measure(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("doc_id", "key", "lang", "source")] + [pa.array(m[k], pa.int64()) for k in MEASURES],
                    ["doc_id", "key", "lang", "source", *MEASURES])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs), row_key(docs).alias("key"),
                        *(F.col(c).cast("string").alias(c) for c in ("lang", "source")))
            .mapInArrow(run, "doc_id long, key long, lang string, source string, " + ", ".join(f"{k} long" for k in MEASURES))
            .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))


def row_key(docs: DataFrame) -> F.Column:
    return F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")), docs["lang"].cast("string"), docs["source"].cast("string"))


def good_documents(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    good = judge(docs, scratch).where("kept").select(F.col("doc_id").alias("good_id"), F.col("key").alias("good_key"))
    return docs.join(good, docs["doc_id"].cast("long").eqNullSafe(good["good_id"]) & (row_key(docs) == good["good_key"]), "left_semi")


def ratios() -> dict[str, F.Column]:
    return {k: F.col(count) / F.greatest(F.col(base), F.lit(1)) for k, (count, base, _, _) in RULES.items()}


def thresholds(found: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per (lang, source) with texts that pass the base rules: low and
    high rate of each rule."""
    made = found.where(~F.col("base_failed")).select("lang", "source", *(r.alias(k) for k, r in ratios().items()))
    group = made.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"), *(F.kll_sketch_agg_double(k, SKETCH_K).alias(k) for k in RULES))
    lang = group.groupBy("lang").agg(F.sum("n").alias("n"), *(F.kll_merge_agg_double(k).alias(k) for k in RULES))
    corpus = lang.agg(F.sum("n").alias("n"), *(F.kll_merge_agg_double(k).alias(k) for k in RULES))

    def bounds(df: DataFrame, tag: str, *keys: str) -> DataFrame:
        out = []
        for k, (_, _, _, at) in RULES.items():
            # the corpus of no text has an empty sketch, which has no quantiles
            q = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(k, F.array(*map(F.lit, at))))
            room = SPREADS * (q[1] - q[0])
            out.append(F.struct((q[0] - room).alias("low"), (q[1] + room).alias("high")).alias(k))
        return df.select(*keys, F.col("n").alias(f"n_{tag}"), F.struct(*out).alias(tag))

    g, a = bounds(group, "group", "lang", "source"), bounds(lang, "lang_", F.col("lang").alias("lang2"))
    last = bounds(corpus, "corpus").first()["corpus"]  # one row, of literals from here on
    rest = F.struct(*(F.struct(*(F.lit(last[k] and last[k][x]).cast("double").alias(x) for x in ("low", "high"))).alias(k)
                      for k in RULES))
    pick = (F.when(F.col("n_group") >= min_rows, F.col("group"))
            .when(F.col("n_lang_") >= min_rows, F.col("lang_")).otherwise(rest))
    return g.join(a, g["lang"].eqNullSafe(a["lang2"])).select("lang", "source", pick.alias("t"))


def judge(docs: DataFrame, scratch: Scratch, min_rows: int = MIN_ROWS) -> DataFrame:
    """The measures of every text with ``base_failed`` and ``kept``."""
    found = scratch.save(features(docs), "features")
    t = scratch.save(thresholds(found, min_rows), "thresholds").withColumnsRenamed({"lang": "lang_t", "source": "source_t"})
    good = F.lit(True)
    for k, (count, base, clump, _) in RULES.items():
        def room(mean: F.Column, clump: int = clump) -> F.Column:
            return SIGMAS * F.sqrt(clump * mean + clump * clump)
        most = F.col("t")[k]["high"] * F.col(base)
        good = good & (F.col(count) <= most + room(most))
        if k in TWO_SIDED:
            least = F.greatest(F.col("t")[k]["low"] * F.col(base), F.lit(0.0))
            good = good & (F.col(count) >= least - room(least))
    # a group without thresholds has no text that passes the base rules
    return (found.join(t, found["lang"].eqNullSafe(t["lang_t"]) & found["source"].eqNullSafe(t["source_t"]), "left")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(good, F.lit(True))))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(docs, Scratch(spark, "quality")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
