"""URL rules by a sort-merge range join (operator 11).

A rule has a host and a path; it fits urls of its host and all subdomains whose
path starts with the rule's.  The longest rule that fits decides.

* Keys: the labels of a host in reverse, each with a dot behind it
  (``www.example.net`` is ``net.example.www.``).  A rule's host then is the
  interval of keys that start with its own, and intervals nest or are disjoint;
  so do the paths of a host's rules.
* Ranges: cuts between about equal numbers of urls, taken from a sample, split
  the order of (key, path, row) into ranges; the sample only decides how even
  they are.  As the order goes down to single rows, a host or a url that holds a
  third of all rows is spread over many ranges.  A url goes to its range, a rule
  to every range that its interval meets (in a range within one host, only if
  its paths meet that range too).  Urls are shuffled once, with no other columns
  than those asked for.
* Sweep: each range is sorted and read once.  A stack holds the rules whose
  interval is open, one level for each nested host, and inside a level its
  paths with a link from each to the longest that it extends.

Hosts are what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the
end, with A-Z lower-cased; ports and user names are part of it.  The path
follows, up to ``?`` or ``#``.  Null urls and those without ``://`` have an empty
host and path.  A rule's null host or path counts as empty: an empty host fits
every url.  Of rules with equal host and path ``block`` wins; of fitting rules of
equal length (host and path) that of the longer host.  Every row of the urls gives
one row, repeated rows too; an empty table gives none, and without rules all
rows get the default verdict.  Very long urls count whole.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch

#: Urls of a range, the most ranges, sampled urls for each, characters of a cut.
RANGE_ROWS, RANGES, SAMPLED, CUT_CHARS = 100_000, 20_000, 16, 64

RULES = [  # fixed values: verdict, host, path
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return _lower(host), F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)


def key(host: Column) -> Column:
    """The host's labels in reverse, each with a dot behind it."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class Level:
    """The rules of one host: paths in ascending order, each with the place of
    the longest path that it extends (-1: none)."""

    def __init__(self, prefix: str, host: str):
        self.prefix, self.host = prefix, host
        self.paths, self.verdicts, self.outer = [], [], []

    def add(self, path: str, verdict: str) -> None:
        at = len(self.paths) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.outer[at]
        self.paths.append(path)
        self.verdicts.append(verdict)
        self.outer.append(at)

    def longest(self, path: str) -> int:
        at = bisect_right(self.paths, path) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.outer[at]
        return at


class Sweep:
    """Reads rules and urls in the order of their keys."""

    def __init__(self):
        self.stack: list[Level] = []

    def close(self, k: str) -> None:
        while self.stack and not k.startswith(self.stack[-1].prefix):
            self.stack.pop()

    def rule(self, prefix: str, host: str, path: str, verdict: str) -> None:
        self.close(prefix)
        if not self.stack or self.stack[-1].prefix != prefix:
            self.stack.append(Level(prefix, host))
        self.stack[-1].add(path, verdict)

    def url(self, k: str, path: str) -> tuple[str | None, str | None]:
        """(rule, verdict) of the longest rule that fits."""
        self.close(k)
        best, found = -1, (None, None)
        for level in reversed(self.stack):  # longer hosts first: they win ties
            at = level.longest(path)
            if at >= 0 and len(level.host) + len(level.paths[at]) > best:
                best = len(level.host) + len(level.paths[at])
                found = (level.host + level.paths[at], level.verdicts[at])
        return found


def sweep(batches):
    """Rows sorted by (range, key, kind, path); kind 0 are rules."""
    state, current = Sweep(), None
    for batch in batches:
        keep, rules, verdicts = [], [], []
        columns = [batch.column(c).to_pylist() for c in ("part", "k", "kind", "host", "path", "verdict")]
        for i, (part, k, kind, host, path, verdict) in enumerate(zip(*columns)):
            if part != current:
                state, current = Sweep(), part
            if kind == 0:
                state.rule(k, host, path, verdict)
            else:
                rule, verdict = state.url(k, path)
                keep.append(i)
                rules.append(rule)
                verdicts.append(verdict)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).take(pa.array(keep, pa.int32())) for c in ("whole", "host", "path")]
            + [pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], ["whole", "host", "path", "rule", "verdict"])


def _cuts(urls: DataFrame, ranges: int, rows: int) -> list[tuple]:
    """Ascending (key, path, row) at which ranges 1, 2, ... begin; keys and
    paths are cut to CUT_CHARS, so their size is bounded."""
    if ranges < 2:
        return []
    every = max(1, rows // (ranges * SAMPLED))
    sample = (urls.where(F.pmod(F.xxhash64("row", F.lit(11)), F.lit(every)) == 0)
              .select(F.substring("k", 1, CUT_CHARS).alias("k"), F.substring("path", 1, CUT_CHARS).alias("path"), "row"))
    points = sorted(tuple(r) for r in sample.collect())  # about RANGES * SAMPLED at most
    return sorted({points[i * len(points) // ranges] for i in range(1, ranges)}) if points else []


def _place(cuts: list[tuple]):
    def run(batches):
        for batch in batches:
            spots = [bisect_right(cuts, row) for row in zip(*(batch.column(c).to_pylist() for c in ("k", "path", "row")))]
            yield pa.RecordBatch.from_arrays([pa.array(spots, pa.int32()), *batch.columns], ["part", *batch.schema.names])
    return run


def _meets(cuts: list[tuple], prefix: str, path: str) -> list[int]:
    """The ranges that hold urls which a rule may fit."""
    first = bisect_right(cuts, (prefix,))
    last = bisect_right(cuts, (prefix[:-1] + "/",)) if prefix else len(cuts)  # no key holds a slash; it follows the dot
    out = []
    for at in range(first, last + 1):
        if 0 < at < len(cuts) and cuts[at - 1][0] == cuts[at][0]:
            # the range lies within one host: its urls' paths run from low to high
            low, high = cuts[at - 1][1], cuts[at][1]
            if high < path or (path < low and not low.startswith(path)):
                continue
        out.append(at)
    return out


def _spread(cuts: list[tuple]):
    def run(batches):
        for batch in batches:
            found = [_meets(cuts, *pair) for pair in zip(batch.column("k").to_pylist(), batch.column("path").to_pylist())]
            take = pa.array([i for i, parts in enumerate(found) for _ in parts], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([p for parts in found for p in parts], pa.int32())]
                                             + [c.take(take) for c in batch.columns], ["part", *batch.schema.names])
    return run


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = (), default: str = "allow",
          scratch: Scratch | None = None) -> DataFrame:
    """host, path, rule and verdict (the default where no rule fits) of each
    row, beside the columns of ``keep`` as the struct ``whole``."""
    scratch = scratch or Scratch(urls.sparkSession, "url-rules")
    spark = scratch.spark
    host, path = host_and_path(F.coalesce(F.col("url").cast("string"), F.lit("")))
    # written, so that the row numbers do not change if a task runs again
    rows = scratch.save(urls.select(F.struct(*(urls[c] for c in keep), F.lit(0).alias("_")).alias("whole"), urls[url].alias("url"))
                        .select("whole", F.monotonically_increasing_id().alias("row"), host.alias("host"), path.alias("path"))
                        .withColumn("k", key(F.col("host"))), "urls")
    n = rows.count()
    ranges = max(1, min(n, RANGES, max(-(-n // RANGE_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))))
    cuts = _cuts(rows, ranges, n)
    known = (rules.select(_lower(F.coalesce(F.col("host").cast("string"), F.lit(""))).alias("host"),
                          F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), "verdict")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block is the greater
             .select(F.when(F.col("host") == "", "").otherwise(key(F.col("host"))).alias("k"), "host", "path", "verdict"))
    shape = "part int, k string, host string, path string"
    placed = known.mapInArrow(_spread(cuts), f"{shape}, verdict string").withColumn("kind", F.lit(0))
    whole = rows.schema["whole"].dataType.simpleString()
    dealt = (rows.select("k", "path", "row", "host", "whole").mapInArrow(
        _place(cuts), f"part int, k string, path string, row long, host string, whole {whole}").withColumn("kind", F.lit(1)))
    both = (dealt.unionByName(placed, allowMissingColumns=True).repartitionById(len(cuts) + 1, F.col("part"))
            .sortWithinPartitions("part", "k", "kind", "path"))
    out = both.mapInArrow(sweep, f"whole {whole}, host string, path string, rule string, verdict string")
    return out.select("whole", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    out = judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules, keep=("page_id",))
    return out.select("whole.page_id", "host", "path", "rule", "verdict")


#: Every rule tried on every url.
ORACLE = r"""
WITH part AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM part
), rules(rule_verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict FROM split LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule,
       coalesce(arg_max(rule_verdict, length(rule)), 'allow') AS verdict
FROM fits GROUP BY page_id, host, path
"""
