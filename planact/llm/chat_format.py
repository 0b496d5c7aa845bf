"""Chat formatting with a round trip through the grammar (built-in functions only).

    conversation := turn*
    turn         := "### " role mode ": " body "</turn>" newline
    mode         := "" (body as it is) | "~" (body escaped)

A body escaped has "~0" for "~", "~1" for "<" and "~2" for "#"; roles are always escaped, with "~3"
for ":". Rendering begins without escapes. The text is parsed again by the grammar (split at the
turn's end, header up to the first ": "), and the turns found are compared with the source. If they
differ, or a body holds a control string, those bodies are escaped and the round repeated, then all
bodies.
The last form holds no control string at all, so it always comes back identical; should it not, the
query raises instead of passing on a damaged conversation.

The loss mask covers the bodies of turns whose role is "assistant".

Defined results: turns are ordered by turn, then role, then text, nulls first; equal rows are turns of
their own. Null texts and roles are empty. A null conv_id is a conversation like any other. A
conversation is one row of output, so its turns meet in one task; conversations are spread. Empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planact.llm.common import col

OPEN, CLOSE, ASSISTANT = "### ", "</turn>\n", "assistant"
_CONTROL = ("</turn>", "### ")
_HEADER = r"(?s)\A### ([^:~]*(?:~[0-3][^:~]*)*?)(~?): "


def escape(text: Column) -> Column:
    for char, code in (("~", "~0"), ("<", "~1"), ("#", "~2")):
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for char, code in (("<", "~1"), ("#", "~2"), ("~", "~0")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("~3"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("~3"), F.lit(":")))


def _render(turns: Column, escaped) -> Column:
    """``escaped(body)``: whether that body is written in escaped form."""

    def one(t: Column) -> Column:
        role, text = _escape_role(t["role"]), t["text"]
        plain = F.concat(F.lit(OPEN), role, F.lit(": "), text, F.lit(CLOSE))
        safe = F.concat(F.lit(OPEN), role, F.lit("~: "), escape(text), F.lit(CLOSE))
        return F.when(escaped(text), safe).otherwise(plain)

    return F.array_join(F.transform(turns, one), "")


def _parts(formatted: Column) -> Column:
    """The turns as written, without their ends; what follows the last end must be empty."""
    return F.split(formatted, r"</turn>\n", -1)


def _parse(formatted: Column) -> Column:
    """Turns (role, text, start, end) as the grammar reads them; places of the bodies in code points."""

    def one(part: Column) -> Column:
        header = F.regexp_extract(part, _HEADER, 0)
        role = _unescape_role(F.regexp_extract(part, _HEADER, 1))
        body = F.substring(part, F.length(header) + 1, F.length(part))
        return F.struct(
            role.alias("role"),
            F.when(F.regexp_extract(part, _HEADER, 2) == "~", unescape(body)).otherwise(body).alias("text"),
            F.length(header).alias("head"),
            F.length(part).alias("size"),
        )

    parts = _parts(formatted)
    return F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), one)


def _source(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def _with_round_trip(df: DataFrame) -> DataFrame:
    """Adds ``formatted`` and ``parsed``: the first form that comes back identical."""
    conflict = lambda text: F.contains(text, F.lit(_CONTROL[0])) | F.contains(text, F.lit(_CONTROL[1]))
    clear = ~F.exists("turns", lambda t: conflict(t["text"]))
    # Each form with what must hold beside equality: a control string never stays as it is.
    forms = (
        (lambda text: F.lit(False), clear),
        (conflict, F.lit(True)),
        (lambda text: F.lit(True), F.lit(True)),
    )
    df = df.withColumn("formatted", F.lit(None).cast("string")).withColumn("same", F.lit(False))
    for form, allowed in forms:
        df = df.withColumn("formatted", F.when(F.col("same"), F.col("formatted")).otherwise(_render(F.col("turns"), form)))
        df = df.withColumn("parsed", _parse(F.col("formatted")))
        df = df.withColumn("same", allowed & (_source(F.col("parsed")) == _source(F.col("turns"))))
    checked = F.when(F.col("same"), F.col("parsed")).otherwise(
        F.raise_error(F.lit("a formatted conversation did not come back identical")).cast(df.schema["parsed"].dataType)
    )
    return df.withColumn("parsed", checked).drop("same")


def format_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation, read back from its formatted text.

    (conv_id, formatted, turns array<struct<role, text, start, end>>, loss_mask array<struct<start, end>>):
    places in code points, ends exclusive; ``text`` is unescaped.
    """
    turns = rows.select(
        col(conv_col).alias("conv_id"),
        F.struct(
            col(turn_col).alias("turn"),
            F.coalesce(col(role_col), F.lit("")).alias("role"),
            F.coalesce(col(text_col), F.lit("")).alias("text"),
        ).alias("t"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    done = _with_round_trip(grouped)
    # Places: each turn begins where the sizes before it, with their ends, add up to.
    step = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins"))
    begins = F.aggregate(
        "parsed",
        step,
        lambda acc, t: F.struct(
            (acc["at"] + t["size"] + len(CLOSE)).alias("at"), F.array_append(acc["begins"], acc["at"]).alias("begins")
        ),
        lambda acc: acc["begins"],
    )
    placed = F.zip_with(
        "parsed",
        "begins",
        lambda t, b: F.struct(
            t["role"].alias("role"), t["text"].alias("text"), (b + t["head"]).alias("start"), (b + t["size"]).alias("end")
        ),
    )
    out = done.withColumn("begins", begins).select("conv_id", "formatted", placed.alias("turns"))
    masked = F.filter("turns", lambda t: t["role"] == ASSISTANT)
    return out.withColumn(
        "loss_mask", F.transform(masked, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and hashes of what ``format_conversations`` read back."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(
        F.transform(F.filter("turns", lambda t: t["role"] == ASSISTANT), lambda t: t["text"]), ""
    )
    return formatted.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
