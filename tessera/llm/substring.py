"""Substring deduplication by relative Lempel-Ziv parsing (operator 7).

The corpus in ascending doc_id is its own reference.  A duplicate passage is
a factor of at least ``width`` words that also starts earlier in it.

1. Texts with equal word sequences form a class; only the smallest doc_id of
   a class is parsed.  A later copy of at least ``width`` words is one factor.
2. Anchors index the reference: of every ``width`` consecutive words, the
   ``GRAM``-word run of least hash (a minimizer).  Equal windows have equal
   anchors at equal places, so a window can repeat only if its anchor does.
   Anchors found in one place only are dropped.
3. The index is sharded by anchor, and an anchor with more than ``SHARD``
   places further by the hashes of its windows, into so many shards that each
   has windows of about ``SHARD`` places.  A text ships the hashes of the
   windows that a repeated anchor stands for as one short record per shard; a
   shard reads its records in corpus order and gives each window the
   first place that had it.  It remembers the distinct windows of one shard at
   a time: at most ``SHARD`` times the windows of a place, however many
   documents share a passage.
4. Each document is factored greedily, left to right: a factor runs on as long
   as the next window's first occurrence is the next word of the same
   reference text; windows across a factor's boundary were looked up like all
   others, so passages that jump between references are covered whole.

Windows of one anchor are told apart by a 64-bit hash of their words, which is
shipped whole; windows of different anchors are never compared.
Null, empty and blank texts have no words; texts under ``width`` words lose
none.  Equal doc_ids are taken in the order of their texts; null doc_ids come
last.  Empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch
from tessera.llm.words import U64, Words, find_words, mix, slices, text_column, unpacked, whole, windows

GRAM = 6
SHARD = 1024  # places of an anchor that one shard takes
CELLS = 1 << 20  # ids hash into so few cells that a set of them can be broadcast


def kept_text(w: Words, i: int, drop: np.ndarray | None = None) -> bytes:
    """The words of text ``i`` that ``drop`` does not mark, by one space."""
    a, b = w.first[i], w.first[i + 1]
    raw = w.data[w.off[i]:w.off[i + 1]].tobytes()
    pairs = zip((w.start[a:b] - w.off[i]).tolist(), (w.end[a:b] - w.off[i]).tolist())
    if drop is None:
        return b" ".join([raw[x:y] for x, y in pairs])
    return b" ".join([raw[x:y] for (x, y), z in zip(pairs, drop.tolist()) if not z])


def remaining(w: Words, i: int, drop: np.ndarray) -> bytes:
    """Text ``i`` without the marked words; white space between words that
    stay neighbours is kept as it was, what is cut leaves one space."""
    a = w.first[i]
    stay = ~drop
    runs = np.flatnonzero(np.diff(np.concatenate([[False], stay, [False]])))
    return b" ".join(w.data[w.start[a + x]:w.end[a + y - 1]].tobytes() for x, y in zip(runs[::2], runs[1::2]))


def anchors(w: Words, h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window (by its first word): the place of its anchor, and the
    hashes of all word runs."""
    gram = mix(windows(h, GRAM))
    span = width - GRAM + 1
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), gram
    best = np.arange(n)
    low = gram[:n].copy()
    for k in range(1, span):  # leftmost of equal hashes
        other = gram[k:k + n]
        less = other < low
        low[less] = other[less]
        best[less] = np.flatnonzero(less) + k
    return best, gram


def whole_windows(w: Words, width: int) -> np.ndarray:
    """Which windows lie inside one text."""
    n = len(w.doc) - width + 1
    return w.doc[:n] == w.doc[width - 1:] if n > 0 else np.zeros(0, bool)


ROW = "id long, no int"


def survey(docs: DataFrame, width: int) -> DataFrame:
    """Per text: its words, the hash of their sequence (that of the kept text
    if nothing is removed), and its anchors with the number of their places."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = find_words(part.column("text"))
                h = w.hashes()
                best, gram = anchors(w, h, width)
                place = np.unique(best[whole_windows(w, width)])
                doc, g = w.doc[place], gram[place]
                order = np.lexsort((g, doc))
                doc, g = doc[order], g[order]
                new = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (doc[1:] != doc[:-1]))[:len(g)])
                times = np.diff(np.append(new, len(g)))
                doc, g = doc[new], g[new].astype(np.int64)
                ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(g), pa.array(times, pa.int64())], ["gram", "times"]))
                sha = [hashlib.sha256(kept_text(w, i)).digest() for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("no"), pa.array(w.counts, pa.int64()), pa.array(sha, pa.binary()), lists],
                    ["id", "no", "n_words", "sha", "anchors"])

    return docs.mapInArrow(run, f"{ROW}, n_words long, sha binary, anchors array<struct<gram:long,times:long>>")


def candidate_windows(docs: DataFrame, width: int) -> DataFrame:
    """One row per text, one of its ``grams`` and shard of it: gram, shard,
    row, start of the first window, the others' distances from it (empty if
    each follows the one before), the windows' hashes.  A text that repeats a
    few words over and over is one row per shard."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = find_words(part.column("text"))
                h = w.hashes()
                best, gram = anchors(w, h, width)
                grams = part.column("grams")
                flat = grams.flatten()
                mask = flat.field("mask").to_numpy(zero_copy_only=False).astype(np.int64)
                flat = flat.field("gram").to_numpy(zero_copy_only=False).astype(np.int64).astype(U64)
                if not len(best) or not len(flat):
                    continue
                owner = np.repeat(np.arange(part.num_rows), grams.value_lengths().to_numpy(zero_copy_only=False))
                known, spot = np.unique(mix(flat + mix(owner.astype(U64) + U64(1))), return_index=True)
                mine = mix(gram[best] + mix(w.doc[:len(best)].astype(U64) + U64(1)))
                at = np.searchsorted(known, mine)
                at[at == len(known)] = 0
                mask = mask[spot[at]]
                at = np.flatnonzero((known[at] == mine) & whole_windows(w, width))
                if not len(at):
                    continue
                hashes = mix(windows(h, width)[at]).astype("<u8")
                mine, shard = gram[best[at]], hashes.astype(np.int64) & mask[at]
                order = np.lexsort((at, shard, mine, w.doc[at]))
                mine, shard, at, hashes = mine[order], shard[order], at[order], hashes[order]
                new = np.flatnonzero(np.append(True, (mine[1:] != mine[:-1]) | (shard[1:] != shard[:-1])
                                               | (w.doc[at[1:]] != w.doc[at[:-1]])))
                raw, ends = hashes.tobytes(), np.append(new[1:], len(at))
                first = at[new]
                doc = w.doc[first]
                far = (at - np.repeat(first, ends - new)).astype("<u4").tobytes()
                run_on = at[ends - 1] - first == ends - new - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mine[new].astype(np.int64)), pa.array(shard[new]), part.column("id").take(pa.array(doc)),
                     part.column("no").take(pa.array(doc)), pa.array((first - w.first[doc]).astype(np.int64)),
                     pa.array([b"" if c else far[4 * a:4 * b] for a, b, c in zip(new.tolist(), ends.tolist(), run_on.tolist())], pa.binary()),
                     pa.array([raw[8 * a:8 * b] for a, b in zip(new.tolist(), ends.tolist())], pa.binary())],
                    ["gram", "shard", "id", "no", "start", "far", "windows"])

    return docs.mapInArrow(run, f"gram long, shard long, {ROW}, start long, far binary, windows binary")


def first_places(found: DataFrame) -> DataFrame:
    """Runs of windows that have an earlier place: row, start, n windows, and
    the reference's row and start."""
    def run(batches):
        none = np.zeros(0, np.int64)
        held, keys, refs = None, np.zeros(0, U64), [none, none, none]  # windows of the shard at the last batch's end
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, shard, ids, no, start = (batch.column(c).to_numpy().astype(np.int64) for c in ("gram", "shard", "id", "no", "start"))
            new = np.append(True, (gram[1:] != gram[:-1]) | (shard[1:] != shard[:-1]))
            group = np.cumsum(new) - 1
            begins, ends = (gram[0], shard[0]), (gram[-1], shard[-1])
            raw = batch.column("windows").to_pylist()
            n = np.fromiter(map(len, raw), np.int64, len(raw)) // 8
            row = np.repeat(np.arange(len(raw)), n)
            at = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            far = batch.column("far").to_pylist()
            apart = np.fromiter(map(bool, far), bool, len(far))[row]
            at[apart] = start[row[apart]] + np.frombuffer(b"".join(far), "<u4")
            key, of = np.frombuffer(b"".join(raw), "<u8"), group[row]
            order = np.lexsort((key, of))  # stable: equal windows stay in corpus order
            fresh = np.append(True, (key[order[1:]] != key[order[:-1]]) | (of[order[1:]] != of[order[:-1]]))
            first, back = order[fresh], np.empty(len(order), np.int64)
            back[order] = np.cumsum(fresh) - 1
            uniq, of = key[first], of[first]
            ref = [ids[row][first], no[row][first], at[first]]
            if held == begins and len(keys):
                spot = np.searchsorted(keys, uniq)
                spot[spot == len(keys)] = 0
                old = (keys[spot] == uniq) & (of == 0)
                for mine, kept in zip(ref, refs):
                    mine[old] = kept[spot[old]]
            last = of == group[-1]
            if held == ends:
                fresh = last & ~np.isin(uniq, keys)
                keys = np.concatenate([keys, uniq[fresh]])
                refs = [np.concatenate([k, m[fresh]]) for k, m in zip(refs, ref)]
                order = np.argsort(keys)
                keys, refs = keys[order], [r[order] for r in refs]
            else:
                held, keys, refs = ends, uniq[last], [m[last] for m in ref]
            rid, rno, rat = (m[back] for m in ref)
            again = (rid != ids[row]) | (rno != no[row]) | (rat != at)
            r, t, a, b, c = row[again], at[again], rid[again], rno[again], rat[again]
            if not len(r):
                continue
            new = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (t[1:] != t[:-1] + 1) | (a[1:] != a[:-1])
                                           | (b[1:] != b[:-1]) | (c[1:] != c[:-1] + 1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[r[new]]), pa.array(no[r[new]].astype(np.int32)), pa.array(t[new]),
                 pa.array(np.diff(np.append(new, len(r)))), pa.array(a[new]), pa.array(b[new].astype(np.int32)), pa.array(c[new])],
                ["id", "no", "start", "n", "ref_id", "ref_no", "ref_start"])

    return (found.repartition("gram", "shard").sortWithinPartitions("gram", "shard", "id", "no", "start")
            .mapInArrow(run, f"{ROW}, start long, n long, ref_id long, ref_no int, ref_start long"))


def factor(runs: list[tuple], width: int) -> list[tuple]:
    """Greedy factors (start, length, reference, its start) of one document
    from the runs (start, n windows, reference, its start) of its windows."""
    out: list[list] = []
    for start, n, ref, at in sorted(runs):
        if out:
            last = out[-1]
            if start == last[0] + last[1] - width + 1 and ref == last[2] and at - start == last[3] - last[0]:
                last[1] += n
                continue
        out.append([start, n + width - 1, ref, at])
    return [tuple(x) for x in out]


def removals(docs: DataFrame, width: int) -> DataFrame:
    """Removes the factors made of ``found`` from the texts."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = find_words(part.column("text"))
                gone, sha, text = [], [], []
                for i, found in enumerate(part.column("found").to_pylist()):
                    drop = np.zeros(int(w.counts[i]), bool)
                    for s, n, _, _ in factor([(x["start"], x["n"], (x["ref_id"], x["ref_no"]), x["ref_start"]) for x in found], width):
                        drop[s:s + n] = True
                    gone.append(int(drop.sum()))
                    sha.append(hashlib.sha256(kept_text(w, i, drop)).digest())
                    text.append(remaining(w, i, drop).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("no"), pa.array(gone, pa.int64()), pa.array(sha, pa.binary()), pa.array(text)],
                    ["id", "no", "n_removed", "sha", "kept_text"])

    return docs.mapInArrow(run, f"{ROW}, n_removed long, sha binary, kept_text string")


def numbered(docs: DataFrame) -> DataFrame:
    """Adds the row's name: ``id``, its doc_id (the largest for a null one),
    and ``no``, which orders rows of equal doc_id by a hash of their text."""
    return (docs.withColumn("id", F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)))
            .withColumn("no", F.hash(F.coalesce(F.col("text").cast("string"), F.lit("")))))


def _with_texts(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` with their texts.  Rows of other documents are left out before
    the texts are shuffled, by the cells of the ids (at most CELLS rows)."""
    cell = F.pmod(F.xxhash64("id"), F.lit(CELLS))
    cells = rows.select(cell.alias("cell")).distinct()
    some = docs.withColumn("cell", cell).join(F.broadcast(cells), "cell", "left_semi").select("id", "no", "text")
    return some.join(rows, ["id", "no"]).dropDuplicates(["id", "no"])


def parse(docs: DataFrame, width: int = 20, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(one row per row: id, no, n_words, n_removed, hash of the kept words;
    the texts of the rows that lost some words and are no copies)."""
    scratch = scratch or Scratch(docs.sparkSession, "substring")
    docs = numbered(docs.select("doc_id", text_column(docs))).select("id", "no", "text")
    seen = scratch.save(survey(docs, width), "survey")
    # Texts of equal words share the hash of their words: the class.
    classes = scratch.save(seen.where(F.col("n_words") >= width).groupBy("sha").agg(
        F.min(F.struct("id", "no")).alias("rep")), "classes")
    reps = classes.select("rep.id", "rep.no")
    places = (seen.select("id", "no", "anchors").join(reps, ["id", "no"], "left_semi").dropDuplicates(["id", "no"])
              .select("id", "no", F.inline("anchors")))
    # An anchor's shards are told by a mask on the hashes of its windows.
    mask = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("n") / SHARD, F.lit(1.0))))).cast("long") - 1
    again = scratch.save(places.withColumn("n", F.sum("times").over(Window.partitionBy("gram"))).where("n > 1")
                         .groupBy("id", "no").agg(F.collect_list(F.struct("gram", mask.alias("mask"))).alias("grams")), "repeated")
    runs = first_places(candidate_windows(_with_texts(again, docs), width))
    hits = scratch.save(runs.groupBy("id", "no").agg(F.collect_list(
        F.struct("start", "n", "ref_id", "ref_no", "ref_start")).alias("found")), "hits")
    cut = scratch.save(removals(_with_texts(hits, docs), width), "cut")
    empty = F.lit(hashlib.sha256(b"").digest())
    copy = F.coalesce((F.col("id") != F.col("rep.id")) | (F.col("no") != F.col("rep.no")), F.lit(False))
    out = (seen.drop("anchors").join(classes, "sha", "left")
           .join(cut.select("id", "no", "n_removed", F.col("sha").alias("cut_sha")), ["id", "no"], "left")
           .withColumn("copy", copy)
           .select("id", "no", "n_words", "copy",
                   F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                   F.when(F.col("copy"), empty).otherwise(F.coalesce("cut_sha", "sha")).alias("sha")))
    return out, cut.select("id", "no", "kept_text")


def without_repeats(docs: DataFrame, width: int = 20, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with every repeated passage cut from all but its first place.

    Rows stay, with empty texts if nothing is left; ``n_chars``, if there is
    such a column, follows the text."""
    out, cut = parse(docs, width, scratch)
    gone = out.where("copy").select("id", "no", F.lit("").alias("new_text")).union(cut)
    done = (numbered(docs.select("doc_id", "text", whole(docs))).select("id", "no", "whole")
            .join(gone.dropDuplicates(["id", "no"]), ["id", "no"], "left"))
    new = F.col("new_text")
    return unpacked(done, docs.columns, {
        "text": F.coalesce(new, F.col("whole")["text"]),
        **({"n_chars": F.when(new.isNull(), F.col("whole")["n_chars"]).otherwise(F.length(new).cast("long"))}
           if "n_chars" in docs.columns else {})})


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = parse(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.when(F.col("id") != 2**63 - 1, F.col("id")).alias("doc_id"), "n_words", "n_removed", F.lower(F.hex("sha")).alias("kept_sha256"))
