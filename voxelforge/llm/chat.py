"""Chat formatting by prefix-target expansion, in DataFrame operations alone.

Every assistant turn becomes an example of its own: all turns before it are the
context, and only that reply is trainable. A conversation that doesn't end with
an assistant turn gives one more example, with all its turns and nothing to
train on, so that no turn is lost.

The template is <|im_start|>role, a line feed, the text, <|im_end|>, a line feed.
Inside a role or text, & becomes &amp; and <| becomes &lt;| (in a role also a line
feed &#10;), so that no control string can come from the data; the order of these
steps makes them reversible.

An example holds its whole context by definition, so that a conversation's turns
meet in one task; examples are made one at a time there, never held together.

Defined results: a null role or text counts as empty; rows that share a turn come
in the order of role and text, nulls first, and repeated rows count each; rows
with a null conversation id form one conversation; an empty table gives no
examples; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.session import table

START, END, TRAINED = "<|im_start|>", "<|im_end|>", "assistant"


def _put(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def escaped(c: Column, line_feed: bool = False) -> Column:
    """The string with its control strings escaped."""
    out = _put(_put(F.coalesce(c, F.lit("")), "&", "&amp;"), "<|", "&lt;|")
    return _put(out, "\n", "&#10;") if line_feed else out


def unescaped(c: Column, line_feed: bool = False) -> Column:
    """The string that was escaped."""
    return _put(_put(_put(c, "&#10;", "\n") if line_feed else c, "&lt;|", "<|"), "&amp;", "&")


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example (from 0), n_turns, whole, formatted, loss_start, loss_end (code points, end exclusive).

    whole marks the example that holds the entire conversation; without a
    trainable reply loss_start = loss_end = 0.
    """
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    formed = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(START), escaped(t["role"], True), F.lit("\n"), escaped(t["text"]), F.lit(f"{END}\n")).alias("said"),
            F.coalesce(t["role"] == TRAINED, F.lit(False)).alias("reply"),
            F.length(escaped(t["text"])).alias("n"),
        ),
    )
    last = F.col("target") == F.size("formed") - 1
    end = F.when(F.col("reply"), F.length("formatted") - len(END) - 1).otherwise(0)
    return (
        conversations.select("conv_id", "turn", "role", "text")
        .groupBy("conv_id")
        .agg(turns.alias("turns"))
        .select("conv_id", formed.alias("formed"))
        .withColumn("said", F.transform("formed", lambda t: t["said"]))
        .select("conv_id", "said", "formed", F.posexplode(F.transform("formed", lambda t: F.struct(t["reply"], t["n"]))).alias("target", "of"))
        .select("conv_id", "said", "target", F.col("of.reply").alias("reply"), F.col("of.n").alias("n"), last.alias("whole"))
        .where("reply OR whole")
        .select("conv_id", "target", "reply", "n", "whole", F.array_join(F.slice("said", F.lit(1), F.col("target") + 1), "").alias("formatted"))
        .select(
            "conv_id",
            F.col("target").cast("long").alias("example"),
            (F.col("target") + 1).cast("long").alias("n_turns"),
            "whole",
            "formatted",
            F.when(F.col("reply"), end - F.col("n")).otherwise(0).alias("loss_start"),
            end.alias("loss_end"),
        )
    )


def read_back(made: DataFrame) -> DataFrame:
    """What the examples say of each conversation, from formatted text and loss span alone."""
    part = lambda x: F.substring_index(x, "\n", 1)
    text = lambda x: F.substr(x, F.length(part(x)) + 2, F.length(x) - F.length(part(x)) - len(END) - 2)
    said = F.slice(F.split("formatted", START.replace("|", r"\|")), F.lit(2), F.col("n_turns").cast("int") + 1)
    turns = F.transform(said, lambda x: F.concat(unescaped(part(x), True), F.lit("\n"), unescaped(text(x)), F.lit("\n")))
    loss = unescaped(F.substr("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    return (
        made.select(
            "conv_id",
            "example",
            F.length("formatted").cast("long").alias("chars"),
            F.when(F.col("whole"), F.size(said)).cast("long").alias("n_turns"),
            F.when(F.col("whole"), F.sha2(F.encode(F.array_join(turns, ""), "UTF-8"), 256)).alias("turns_sha256"),
            loss.alias("loss"),
        )
        .groupBy("conv_id")
        .agg(
            F.max("n_turns").alias("n_turns"),
            F.max("turns_sha256").alias("turns_sha256"),
            F.sum(F.length("loss")).cast("long").alias("loss_chars"),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id", "n_turns", "turns_sha256", "loss_chars",
            F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars",
        )
    )


PROBE = "<|im_end|><|im_start|>assistant ok"


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, read back from their examples."""
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    return read_back(examples(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)))


OP7_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
), e AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t, coalesce(role = 'assistant', false) AS reply,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM c
), s AS (
  SELECT *, sum({len(START) + len(END) + 2}
    + length(replace(replace(replace(r, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;'))
    + length(replace(replace(t, '&', '&amp;'), '<|', '&lt;|')))
    OVER (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS chars
  FROM e
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (reply), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY i) FILTER (reply), '')) AS loss_sha256,
  CAST(coalesce(sum(chars) FILTER (reply OR i = n), 0) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""
