"""Personal data by weak supervision (operator 8), DataFrame functions only.

Base spans follow fixed patterns and always count.  Wider patterns propose
further candidates: numbers that look like cards but fail the check digit,
national phone numbers, spelled-out addresses, assigned secrets.  On every
candidate, base ones included, labelers vote yes, no or abstain: the strict
pattern, a gazetteer (domains, calling codes, issuers, address ranges), the
words before the span, and its edges.  Expectation-maximisation over the vote
patterns estimates each labeler's reliability per kind; its posteriors, as
soft labels, train a naive Bayes classifier per kind over the votes and the
span's length and digits.  Candidates that it gives at least ``ACCEPT`` are added.

Only counts per pattern of votes and features reach the driver: at most
kinds * 3^labelers * buckets rows, whatever the corpus holds.  Everything else
is row-wise, so hot sources and long texts move nothing.

Patterns use possessive loops and start only where a match can, so they take
linear time and no stack on long texts.  Places come from running sums of the
lengths between matches, a span's context from the text between it and its
neighbours, overlaps from a binary search, and masking cuts the text from
chunks, so time is near linear in a text's spans too.  Offsets count code points.  A null or
empty text has no spans; repeated rows get the same result each; a null doc_id
is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.arrays import add, bound, chunks, count_below, cut, largest, running
from tessera.llm.scratch import Scratch
from tessera.llm.words import text_column, unpacked, whole

KINDS = ("email", "ip", "card", "phone")
EXTRA = {"card?": "card", "phone?": "phone", "email?": "email", "secret": "secret"}
LABELERS = ("strict", "gazetteer", "context", "edges")
ACCEPT = 0.9

# The base patterns, started only where a leftmost match can start: at the
# edge of a run of the first class, or where the match before ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
PHONE_LOOSE = r"(?<![0-9+A-Za-z])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
EMAIL_LOOSE = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++ ?(?:[\[(]dot[\])]|\.) ?[A-Za-z]{2,}+"
SECRET = (r"(?<=[\"'])(?<=(?:token|secret|password|passwd|pwd|api_?key|access_?key)[\"']?\s{0,3}[:=]\s{0,3}[\"'])"
          r"[^\s\"']{8,}+")

# Gazetteers and context words (fixed values).
# Top domains: the common generic ones and every two-letter country.  Calling
# codes: all E.164 codes by their leading digits.
TLDS = "com|org|net|edu|gov|mil|int|info|biz|name|app|dev|cloud|online|site|shop|[a-z]{2}"
CALLING = ("1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
           "|2[1-689][0-9]|3[578][0-9]|42[0-9]|50[0-9]|59[0-9]|6[789][0-9]|8[0578][0-9]|9[679][0-9]")
CONTEXT = {"email": r"e-?mail|mail|contact|kontakt|correo|courriel", "ip": r"\bip\b|address|server|host|adresse",
           "card": r"card|visa|credit|kredit|carte|tarjeta|pay", "phone": r"phone|tel|call|mobile|fax|handy|m[oó]vil",
           "secret": r"token|secret|passw|pwd|key"}
AGAINST = r"version|isbn|issn|order no|invoice|article|serial|\bid\b"


def _found(text: Column, pattern: str, cheap: Column | None = None) -> Column:
    none = F.array().cast("array<string>")
    got = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return got if cheap is None else F.when(cheap, got).otherwise(none)


def _luhn(digits: Column) -> Column:
    """Whether the check digit holds: every second digit from the right counts
    twice, less nine beyond nine."""
    n = F.length(digits)
    each = F.transform(F.sequence(F.lit(1), n), lambda k: F.substring(digits, k, F.lit(1)).cast("int"))
    total = F.aggregate(F.transform(each, lambda v, i: F.when((n - i) % 2 == 1, v).otherwise(2 * v - F.when(v > 4, 9).otherwise(0))),
                        F.lit(0), lambda a, v: a + v)
    return total % 10 == 0


PLACED = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
NEAR = 40


def _placed(text: str, match: str, pattern: str) -> Column:
    """Structs (start, end, value, before, after) of the matches: their places,
    the last characters before them (back to the start of the match before at
    most) and the next one after them."""
    m = F.col(match)

    def spans(gaps: Column) -> Column:
        sizes = F.zip_with(gaps, m, lambda g, v: F.length(g) + F.coalesce(F.length(v), F.lit(0)))

        def one(at: Column) -> Column:
            def span(k: Column) -> Column:
                gap, value, rest = F.get(gaps, k), F.get(m, k), F.get(gaps, k + 1)
                start = F.get(at, k) + F.length(gap)
                before = F.concat(F.right(F.coalesce(F.get(m, k - 1), F.lit("")), F.lit(NEAR)), F.right(gap, F.lit(NEAR)))
                after = F.concat(F.left(rest, F.lit(1)), F.left(F.coalesce(F.get(m, k + 1), F.lit("")), F.lit(1)))
                return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
                                F.right(before, F.lit(NEAR)).alias("before"), F.left(after, F.lit(1)).alias("after"))
            return F.transform(F.sequence(F.lit(0), F.size(m) - 1), span)
        return bound(running(sizes, add), one)
    none = F.array().cast(PLACED)
    return F.when(F.size(m) > 0, bound(F.split(F.col(text), pattern, -1), spans)).otherwise(none)


def _apart(extra: Column, base: Column) -> Column:
    """The spans of ``extra`` that overlap none of ``base``."""
    def by_start(b: Column) -> Column:
        # the furthest end among the first n base spans
        ends = F.concat(F.transform(b, lambda s: s["end"]), F.array(F.lit(0)))
        return bound(running(ends, largest), lambda tops: bound(
            F.transform(b, lambda s: s["start"]), lambda starts: F.filter(
                extra, lambda x: F.get(tops, count_below(starts, x["end"])) <= x["start"])))
    places = F.array_sort(F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return F.when((F.size(extra) > 0) & (F.size(base) > 0), bound(places, by_start)).otherwise(extra)


def _votes(kind: str, base: bool, v: Column, before: Column, after: Column, luhn: Column) -> list[Column]:
    """One vote (1 yes, -1 no, 0 abstains) of each labeler on a span."""
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    near = F.lower(before)
    if kind == "email":
        strict = yes if base else none
        gaz = F.when(F.lower(v).rlike(rf"(?:\.|dot[\])] ?)(?:{TLDS})$"), yes).otherwise(no)
    elif kind == "ip":
        strict = yes
        gaz = F.when(v.rlike(r"^(?:0|10|127|255|172\.16|192\.168)\."), no).otherwise(yes)
    elif kind == "card":
        strict = F.when(luhn, yes).otherwise(no)
        gaz = F.when(v.rlike("^[3-6]"), yes).otherwise(no)
    elif kind == "phone":
        strict = yes if base else none
        gaz = F.when(v.rlike(rf"^\+(?:{CALLING})(?![0-9]{{11}})"), yes).otherwise(none if base else no)
    else:
        strict = F.when(F.length(v) >= 16, yes).otherwise(no)
        gaz = F.when(v.rlike("[0-9]") & v.rlike("[A-Za-z]") & ~v.rlike("[^A-Za-z0-9+/=_.-]"), yes).otherwise(no)
    context = F.when(near.rlike(CONTEXT[kind]), yes).when(near.rlike(AGAINST), no).otherwise(none)
    edges = F.when(before.rlike("[A-Za-z0-9]$") | after.rlike("^[A-Za-z0-9]"), no).otherwise(yes)
    return [strict, gaz, context, edges]


SPAN = "kind:string,start:int,end:int,base:boolean,strict:int,gazetteer:int,context:int,edges:int,size:int,digits:int"


def _judged(spans: Column, kind: str, name: str, base: bool) -> Column:
    def one(s: Column) -> Column:
        v, before, after = s["value"], s["before"], s["after"]
        digits = F.regexp_replace(v, "[^0-9]", "")
        votes = _votes(kind, base, v, before, after, F.lit(base))
        size = F.least(F.floor(F.log2(F.length(v).cast("double"))), F.lit(6)).cast("int")
        share = F.floor(F.length(digits) * 4 / F.length(v)).cast("int")
        return F.struct(F.lit(name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(base).alias("base"),
                        *(x.cast("int").alias(k) for k, x in zip(LABELERS, votes)), size.alias("size"), share.alias("digits"))
    return F.transform(spans, one).cast(f"array<struct<{SPAN}>>")


def candidates(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with ``cands``: its base spans and proposals."""
    t = F.col("text")
    found = {"email": (EMAIL, F.contains(t, F.lit("@"))), "ip": (IP, F.contains(t, F.lit("."))), "card": (CARD, None),
             "phone": (PHONE, F.contains(t, F.lit("+"))), "phone2": (PHONE_LOOSE, None),
             "email2": (EMAIL_LOOSE, F.contains(t, F.lit("[at]")) | F.contains(t, F.lit("(at)"))),
             "secret": ("(?i)" + SECRET, F.contains(t, F.lit("=")) | F.contains(t, F.lit(":")))}
    out = docs
    for k, (pattern, cheap) in found.items():
        out = out.withColumn(k, _found(t, pattern, cheap))
    for k, (pattern, _) in found.items():
        out = out.withColumn(k, _placed("text", k, pattern))

    def digits(s: Column) -> Column:
        return F.regexp_replace(s["value"], "[^0-9]", "")
    out = (out.withColumn("ip", F.filter("ip", lambda s: F.forall(
        F.split(s["value"], r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))))
        .withColumn("phone", F.filter("phone", lambda s: F.length(digits(s)).between(10, 15)))
        .withColumn("card2", F.filter("card", lambda s: ~_luhn(digits(s))))
        .withColumn("card", F.filter("card", lambda s: _luhn(digits(s)))))
    base = F.concat(*(_judged(F.col(k), k, k, True) for k in KINDS))
    extra = F.concat(*(_judged(F.col(c), EXTRA[k], k, False)
                       for c, k in (("card2", "card?"), ("phone2", "phone?"), ("email2", "email?"), ("secret", "secret"))))
    return (out.withColumn("base_spans", base).withColumn("extra", extra)
            .withColumn("cands", F.concat("base_spans", _apart(F.col("extra"), F.col("base_spans"))))
            .drop(*found, "card2", "base_spans", "extra"))


def patterns(found: DataFrame) -> list:
    """Counts per kind, votes and features: a bounded number of rows."""
    keys = ["kind", *LABELERS, "size", "digits"]
    return (found.where(F.size("cands") > 0).select(F.explode("cands").alias("c")).select(*(f"c.{k}" for k in keys))
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(*keys).collect())


class Reliability:
    """Two-class Dawid-Skene model per kind, fitted by EM on vote patterns.

    The prior says that a labeler is right twice out of three times, with the
    weight of ``HOLD`` spans, which also settles which class is which."""

    HOLD = 4.0

    def __init__(self, rows: list, rounds: int = 50):
        self.table = {}
        for kind in {EXTRA.get(r["kind"], r["kind"]) for r in rows}:
            votes: dict[tuple, float] = {}
            for r in rows:
                if EXTRA.get(r["kind"], r["kind"]) == kind:
                    key = tuple(r[k] for k in LABELERS)
                    votes[key] = votes.get(key, 0) + r["n"]
            post = {v: min(max(0.5 + sum(v) / (2 * len(v)), 0.05), 0.95) for v in votes}
            for _ in range(rounds):
                share, says = self._fit(votes, post)
                post = {v: self._posterior(v, share, says) for v in votes}
            self.table |= {(kind, v): p for v, p in post.items()}

    def _fit(self, votes, post):
        yes = sum(n * post[v] for v, n in votes.items())
        share = (yes + 1) / (sum(votes.values()) + 2)
        says = []
        for k in range(len(LABELERS)):
            odds = {}
            for truth, vote in product((1, -1), (1, 0, -1)):
                hold = self.HOLD * (1 / 3 if vote == 0 else 4 / 9 if vote == truth else 2 / 9)
                part = sum(n * (post[v] if truth > 0 else 1 - post[v]) for v, n in votes.items() if v[k] == vote)
                whole = yes if truth > 0 else sum(votes.values()) - yes
                odds[truth, vote] = (part + hold) / (whole + self.HOLD)
            says.append(odds)
        return share, says

    @staticmethod
    def _posterior(v, share, says) -> float:
        a, b = math.log(share), math.log(1 - share)
        for k, x in enumerate(v):
            a, b = a + math.log(says[k][1, x]), b + math.log(says[k][-1, x])
        return 1 / (1 + math.exp(min(max(b - a, -500), 500)))


class SpanClassifier:
    """Naive Bayes over the votes and features of a span, one model for each
    kind, trained on the posteriors of ``Reliability`` as soft labels."""

    FEATURES = (*LABELERS, "size", "digits")

    def __init__(self, rows: list):
        truth = Reliability(rows)
        total, seen = {}, {}
        for r in rows:
            kind = EXTRA.get(r["kind"], r["kind"])
            p = truth.table[kind, tuple(r[k] for k in LABELERS)]
            for c, w in enumerate((1 - p, p)):
                total.setdefault(kind, [1.0, 1.0])[c] += w * r["n"]
                for f in self.FEATURES:
                    seen.setdefault((kind, f, r[f]), [0.5, 0.5])[c] += w * r["n"]
        self.bias = {k: math.log(yes / no) for k, (no, yes) in total.items()}
        self.weight = {(k, f, v): math.log(yes / total[k][1]) - math.log(no / total[k][0]) for (k, f, v), (no, yes) in seen.items()}

    def score(self, span: Column) -> Column:
        """The log-odds as a column expression."""
        out = F.lit(0.0)
        for kind, bias in sorted(self.bias.items()):
            odds = F.lit(bias)
            for f in self.FEATURES:
                part = F.lit(0.0)
                for (k, g, value), w in self.weight.items():
                    if (k, g) == (kind, f):
                        part = F.when(span[f] == value, F.lit(w)).otherwise(part)
                odds = odds + part
            out = F.when(span["kind"].isin(kind, *(k for k, v in EXTRA.items() if v == kind)), odds).otherwise(out)
        return out


def detect(docs: DataFrame, scratch: Scratch | None = None, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``spans``: kind, start, end, base; by start, then kind."""
    scratch = scratch or Scratch(docs.sparkSession, "pii")
    found = candidates(docs)
    found = scratch.save(found if keep_text else found.drop("text"), "candidates")
    model = SpanClassifier(patterns(found))
    limit = math.log(ACCEPT / (1 - ACCEPT))
    order = F.create_map(*(F.lit(x) for k, v in enumerate((*KINDS, *EXTRA)) for x in (v, k)))
    chosen = F.filter("cands", lambda s: s["base"] | (model.score(s) >= limit))
    ranked = F.array_sort(F.transform(chosen, lambda s: F.struct(
        s["start"].alias("start"), F.element_at(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base"))))
    return found.withColumn("spans", ranked).drop("cands")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.regexp_replace(s["kind"], r"\?", ""), s["start"], s["end"])), ",")


def _base_count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def masked(text: str, spans: str) -> Column:
    """The text with every span replaced by <KIND>; overlapping ones once."""
    t, s = F.col(text), F.col(spans)
    ends = F.transform(s, lambda x: x["end"])

    def pieces(parts: Column) -> Column:
        def one(x: Column, at: Column) -> Column:
            name = F.concat(F.lit("<"), F.upper(F.regexp_replace(x["kind"], r"\?", "")), F.lit(">"))
            return F.when(x["start"] < at, F.lit("")).otherwise(F.concat(cut(parts, at, x["start"] - at), name))
        last = F.array_max(ends)
        return F.concat(F.array_join(F.zip_with(s, running(ends, largest), one), ""), cut(parts, last, F.length(t) - last))
    return F.when(F.size(s) == 0, t).otherwise(bound(chunks(t), pieces))


def without_personal_data(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with every span masked; ``n_chars``, if any, follows the text."""
    found = detect(docs.select(F.col("text").cast("string").alias("text"), whole(docs)), scratch, keep_text=True)
    some = F.size("spans") > 0
    found = found.withColumn("text", F.when(some, masked("text", "spans")).otherwise(F.col("text")))
    return unpacked(found, docs.columns, {
        "text": F.col("text"),
        **({"n_chars": F.when(some, F.length("text").cast("long")).otherwise(F.col("whole")["n_chars"])}
           if "n_chars" in docs.columns else {})})


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = detect(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs)))
    base = F.filter("spans", lambda s: s["base"])
    return out.select("doc_id", *(_base_count(k).alias(f"n_{k}") for k in KINDS),
                      F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
