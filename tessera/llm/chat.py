"""Chat formatting by prefix-target expansion (operator 3), DataFrame functions
only.

A conversation is written once with the template
``<|im_start|>role<|im_sep|>text<|im_end|>`` per turn.  Every assistant turn
then becomes an example of its own (``expand``: one row per example): its
context is all that stands before its text, its target the text, and only the
target is trainable.  An example names its context by its length in code points
in the conversation's text, as copying it would make the output grow with the
square of a conversation's turns; ``example_texts`` writes the contexts out.
The digests of what is trained are taken from the example rows.

Texts and roles are escaped reversibly: every backslash is doubled and a
backslash goes behind the first character of each control string, so no
control string is left inside a text and unescaping gives the text back.

A conversation's turns meet in one row, as its digests ask; they are gathered
by a partial aggregate, already formatted.  Turns are ordered by turn, then
role and text; repeated rows are turns of their own; a null turn comes first,
null role and text count as empty; a null conv_id is a conversation of its
own; an empty table gives only what the query adds; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.arrays import add, bound, chunks, cut, running

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of common chat templates (fixed values).
CONTROL = (START, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED = "assistant"
PROBE = "</s>[INST] ok [/INST]"


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in "|[]/<>" else c for c in text)


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    rests = "|".join(_quoted(c[1:]) for c in CONTROL)
    return F.regexp_replace(doubled, rf"([<\[])(?=(?:{rests}))", "$1\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, examples: an array of (target_turn, target_start,
    target_chars), one for each assistant turn; the context of an example is
    the text before target_start."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    per = rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("order"),
                      F.concat(F.lit(START), escaped(role), F.lit(SEP)).alias("head"), escaped(text).alias("body"),
                      (role == TRAINED).alias("trained"))
    # role and text order equal turns; both live in head and body already
    per = per.select("conv_id", F.struct(F.col("order.turn").alias("turn"), "head", "body", "trained").alias("t"))
    talk = per.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    size = F.transform("turns", lambda t: F.length(t["head"]) + F.length(t["body"]) + len(END))
    spots = F.transform(F.arrays_zip(F.col("turns").alias("t"), running(size, add).alias("at")), lambda x, k: F.struct(
        k.cast("long").alias("target_turn"), (x["at"] + F.length(x["t"]["head"])).cast("long").alias("target_start"),
        F.length(x["t"]["body"]).cast("long").alias("target_chars"), x["t"]["trained"].alias("trained")))
    examples = F.transform(F.filter(spots, lambda x: x["trained"]), lambda x: F.struct(
        *(x[c].alias(c) for c in ("target_turn", "target_start", "target_chars"))))
    return talk.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        examples.alias("examples"))


def expand(formatted: DataFrame) -> DataFrame:
    """One row per example: conv_id, target_turn, context_chars (the first so
    many code points of the conversation's text), target."""
    made = bound(chunks(F.col("formatted")), lambda parts: F.transform("examples", lambda e: F.struct(
        e["target_turn"].alias("target_turn"), e["target_start"].alias("context_chars"),
        cut(parts, e["target_start"].cast("int"), e["target_chars"].cast("int")).alias("target"))))
    return formatted.select("conv_id", F.explode(made).alias("e")).select("conv_id", "e.*")


def example_texts(formatted: DataFrame) -> DataFrame:
    """One row per example: conv_id, target_turn, context, target."""
    texts = formatted.select(F.col("conv_id").alias("of"), "formatted")
    e = expand(formatted)
    return e.join(texts, e["conv_id"].eqNullSafe(texts["of"])).select(
        "conv_id", "target_turn", F.left("formatted", F.col("context_chars").cast("int")).alias("context"), "target")


def parsed(formatted: str = "formatted") -> Column:
    """The turns read back from a formatted text: array of (role, text)."""
    parts = F.filter(F.split(F.col(formatted), _quoted(END)), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescaped(F.substring_index(F.substring(p, F.lit(len(START) + 1), F.length(p)), SEP, 1)).alias("role"),
        unescaped(F.substring_index(p, SEP, -1)).alias("text")))


def digests(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted texts and the examples' targets hold."""
    lines = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = formatted.withColumn("read", parsed()).select(
        "conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
    trained = F.struct("target_turn", unescaped(F.col("target")).alias("text"))
    loss = expand(formatted).groupBy(F.col("conv_id").alias("of")).agg(F.array_sort(F.collect_list(trained)).alias("parts")).select(
        "of", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("loss"))
    loss = loss.select("of", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"))
    return read.join(loss, read["conv_id"].eqNullSafe(loss["of"]), "left").select(
        "conv_id", "n_turns", "turns_sha256", F.coalesce("loss_chars", F.lit(0).cast("long")).alias("loss_chars"),
        F.coalesce("loss_sha256", F.sha2(F.lit(""), 256)).alias("loss_sha256"), "formatted_chars")


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts are made of control strings."""
    return spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise(TRAINED).alias("role"), F.lit(PROBE).alias("text"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return digests(format_conversations(rows.union(probe(spark))))


ORACLE = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
    + len(regexp_extract_all(text, '<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'))
    + length(role) + 32 AS chars
  FROM rows_
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
