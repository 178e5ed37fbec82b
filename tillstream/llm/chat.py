"""Chat formatting: every assistant turn becomes an example of its own.

Only DataFrame functions.  The template marks turns with TURN, SAYS and END; control
strings inside roles and texts are escaped with a backslash and can be restored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
# Strings that chat templates and tokenizers treat as control marks.
CONTROL = [
    TURN, SAYS, END,
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|startoftext|>", "<|endoftext|>",
]


def escape(text: Column) -> Column:
    """No control string is left: a backslash follows its first character, others are doubled."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        text = F.replace(text, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def prefix_examples(conversations: DataFrame) -> DataFrame:
    """Examples of conversations (conv_id, turn, role, text), one row each:

    conv_id, example (from 0), last (whether it is the conversation's last), formatted,
    loss_start and loss_end (code points of formatted; the trainable reply lies between).

    An example holds all turns before an assistant turn and that turn; only its text is
    trainable.  Turns after the last assistant turn are context of a last example that
    has nothing trainable (loss_start = loss_end), so that no turn is lost.  Turns are
    sorted by (turn, role, text), nulls first; repeated rows are turns of their own.  A
    null role or text is empty; a null conv_id is one conversation.  Other columns are
    ignored; an empty table gives no example.
    """
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    shown = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS), escape(F.col("text")), F.lit(END))
    each = turns.select("conv_id", F.struct("turn", "role", "text", shown.alias("shown")).alias("t"))
    whole = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")).select(
        "conv_id",
        F.transform("turns", lambda t: t["shown"]).alias("shown"),
        F.transform("turns", lambda t: t["role"] == "assistant").alias("reply"),
    )
    n = F.size("reply")
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: F.get("reply", i - 1) | (i == n))
    listed = whole.select("conv_id", "shown", "reply", F.posexplode(ends).alias("example", "end"))
    formatted = F.array_join(F.slice("shown", 1, F.col("end")), "")
    last_turn = F.get("shown", F.col("end") - 1)
    size, trained = F.length("formatted"), F.get("reply", F.col("end") - 1)
    head = len(TURN) + len("assistant") + len(SAYS)
    return listed.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        (F.col("end") == n).alias("last"),
        formatted.alias("formatted"),
        trained.alias("_trained"),
        F.length(last_turn).alias("_turn"),
    ).select(
        "conv_id",
        "example",
        "last",
        "formatted",
        F.when(F.col("_trained"), size - F.col("_turn") + head).otherwise(size).alias("loss_start"),
        F.when(F.col("_trained"), size - len(END)).otherwise(size).alias("loss_end"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """What the examples of each conversation hold, read from their formatted texts:

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples.
    """
    masked = F.substring("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    per = examples.select(
        "conv_id",
        F.struct("example", unescape(masked).alias("text")).alias("loss"),
        F.when(F.col("last"), F.col("formatted")).alias("full"),
        F.length("formatted").cast("long").alias("chars"),
    )
    whole = per.groupBy("conv_id").agg(
        F.max("full").alias("full"),
        F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: x["text"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_examples"),
    )
    parts = F.slice(F.split("full", r"<\|end\|>"), 1, F.size(F.split("full", r"<\|end\|>")) - 1)

    def restored(part: Column) -> Column:
        role = F.substring_index(F.substring(part, len(TURN) + 1, F.length(part)), SAYS, 1)
        text = F.substring(part, F.length(role) + len(TURN) + len(SAYS) + 1, F.length(part))
        return F.concat(unescape(role), F.lit("\n"), unescape(text), F.lit("\n"))

    return whole.select(
        "conv_id",
        F.size(parts).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(parts, restored), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
    )
