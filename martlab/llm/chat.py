"""Chat formatting: typed content parts become one text per conversation with a loss mask and attachment records.

The template opens each turn with `<|im_start|>role`, a line feed, and closes it with `<|im_end|>` and a line feed.
Inside roles and texts `&`, `<`, `[` (and a line feed in a role) are written as `&amp;`, `&lt;`, `&lsqb;`, `&nl;`, so no control string of this
template, nor `</s>` or `[INST]`, can stand in a text, and reading back gives every character again.

A visitor turns each part into text: a text part is escaped; an image, audio or document part becomes one placeholder
`<|image|>`, `<|audio|>`, `<|document|>`, in the order of the parts. Its reference and the tokens it expands to are recorded.

Only DataFrame functions are used. A conversation is one row of the result, so its turns meet in one task; nothing
else does. Defined cases: a null text or role is empty; a null part adds nothing; a part of another type is text;
null token counts are 1 for an attachment; rows with equal turn numbers are ordered by role and content; a null
conversation id is a conversation of its own; further columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
ATTACHMENTS = ("image", "audio", "document")
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))
ROLE_ESCAPES = (("\n", "&nl;"),)

PARTS = "array<struct<type:string,text:string,ref:string,tokens:int>>"


def escape(text: Column, role: bool = False) -> Column:
    for plain, coded in ESCAPES + (ROLE_ESCAPES if role else ()):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, role: bool = False) -> Column:
    for plain, coded in reversed(ESCAPES + (ROLE_ESCAPES if role else ())):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """A content of one text part."""
    return F.array(F.struct(
        F.lit("text").alias("type"), text.cast("string").alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens")))


def is_attachment(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*ATTACHMENTS), F.lit(False))


def visit(part: Column) -> Column:
    """Text of one part."""
    return (F.when(is_attachment(part), F.concat(F.lit("<|"), part["type"], F.lit("|>")))
            .otherwise(F.coalesce(escape(part["text"]), F.lit(""))))


def flatten(parts: Column) -> Column:
    return F.array_join(F.transform(F.coalesce(parts, F.array().cast(PARTS)), visit), "")


def format_chat(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation from rows (conv_id, turn, role, parts).

    Returns conv_id, `formatted`, `segments` (array of text and loss; joined they are `formatted`), `attachments`
    (turn position, part position, type, ref, tokens) and `attachment_tokens`, their sum.
    """
    content = F.struct(
        "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), flatten(F.col("parts")).alias("content"),
        F.coalesce(F.filter(
            F.transform(F.col("parts"), lambda p, i: F.struct(
                i.alias("part"), p["type"].alias("type"), p["ref"].alias("ref"),
                F.coalesce(p["tokens"], F.lit(1)).alias("tokens"))),
            lambda a: is_attachment(a)), F.array().cast("array<struct<part:int,type:string,ref:string,tokens:int>>"),
        ).alias("attached"))
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(content)).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(F.concat(F.lit(OPEN), escape(t["role"], role=True), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
        F.struct(t["content"].alias("text"), t["role"].isin(*loss_roles).alias("loss")),
        F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")))))
    attachments = F.flatten(F.transform("turns", lambda t, i: F.transform(t["attached"], lambda a: F.struct(
        i.alias("turn"), a["part"].alias("part"), a["type"].alias("type"), a["ref"].alias("ref"),
        a["tokens"].alias("tokens")))))
    return (grouped.select("conv_id", segments.alias("segments"), attachments.alias("attachments"))
            .select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                    "segments", "attachments",
                    F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
                    .alias("attachment_tokens")))


def read_turns(formatted: Column) -> Column:
    """Roles and texts of a formatted conversation, unescaped; attachments stay as their placeholders."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    close = F.lit(len(CLOSE))
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(p, "\n", 1), role=True).alias("role"),
        unescape(F.substr(p, F.length(F.substring_index(p, "\n", 1)) + F.lit(2),
                          F.length(p) - F.length(F.substring_index(p, "\n", 1)) - F.lit(1) - close)).alias("text")))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def chat_digests(chats: DataFrame) -> DataFrame:
    """The columns of the contract, read back from `formatted` and its mask."""
    return (chats.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                         loss_text(F.col("segments")).alias("loss"))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
                        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


def op9_chat_formatting(spark, folder: str) -> DataFrame:
    """All conversations and conversation -1, whose texts are control strings."""
    given = spark.read.parquet(f"{folder}/conversations.parquet").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    tricky = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = given.unionByName(tricky).select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts"))
    return chat_digests(format_chat(turns))


OP9_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
coded AS (
  SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;') AS body,
         replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), chr(10), '&nl;') AS head
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(head) + length(body) + 12 + 1 + 11)::BIGINT AS formatted_chars
FROM coded GROUP BY conv_id
"""
