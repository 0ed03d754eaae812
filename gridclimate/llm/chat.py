"""Chat formatting with a grammar round trip (operator 8, native).

Grammar: conversation = turn*, turn = "### " role ": " text "</turn>" newline. The parser
cuts at every end mark, takes the last header of a piece, and undoes the escapes `\\\\`
(backslash), `\\#` ("###"), `\\/` ("</turn>") and, in roles, `\\c` (": "). Method: a turn is first rendered as it is
and parsed again; if what comes back differs, because its text or role holds a control
string or what reads like an escape, the three are escaped and the turn is rendered anew.
Escaped content holds neither "###" nor "</turn>", and undoing it gives the source, so the second
rendering always comes back identical; the round trip of the whole conversation is
checked once more and reported in `identical`.

A conversation is one row of the output and thus one group; turns are ordered by turn,
role and text. Offsets of the loss spans come from a running sum over the turns.

Defined cases: null roles and texts are empty; null conversation ids form one
conversation; repeated turns stay repeated, side by side; an empty table gives no rows;
long texts are rendered and parsed whole; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, MIDDLE, END = "### ", ": ", "</turn>"
LEARNT = "assistant"


def escape(text: Column) -> Column:
    """Backslash, "###" and the end mark as escapes."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("###"), F.lit("\\#")), F.lit(END), F.lit("\\/"))


def escape_role(role: Column) -> Column:
    """Escapes of a role, which may hold no middle mark either."""
    return F.replace(escape(role), F.lit(MIDDLE), F.lit("\\c"))


def unescape(text: Column) -> Column:
    """Undo escapes from left to right: between pairs of backslashes, a single one opens an escape."""
    def single(part: Column) -> Column:
        out = F.replace(F.replace(part, F.lit("\\#"), F.lit("###")), F.lit("\\/"), F.lit(END))
        return F.replace(out, F.lit("\\c"), F.lit(MIDDLE))

    return F.array_join(F.transform(F.split(text, r"\\\\"), single), "\\")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(MIDDLE), text, F.lit(END + "\n"))


def parse(rendered: Column) -> Column:
    """Turns (role, text, and body as it stands) of a rendered conversation; anything outside the grammar is a null turn."""
    pieces = F.split(rendered, END)
    turns = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        own = F.element_at(F.split(piece, HEAD), -1)  # what follows the last header mark
        cut = F.locate(MIDDLE, own)
        body = F.substr(own, cut + len(MIDDLE))
        return F.when((F.instr(piece, HEAD) > 0) & (cut > 0), F.struct(
            unescape(F.substr(own, F.lit(1), cut - 1)).alias("role"), unescape(body).alias("text"), body.alias("body")))

    return F.transform(turns, turn)


def _turns(rows: DataFrame) -> DataFrame:
    """Each turn with its rendering, escaped if it does not come back as it was."""
    clean = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    plain = clean.withColumn("plain", render(F.col("role"), F.col("text")))
    back = plain.withColumn("back", parse(F.col("plain")))
    same = (F.size("back") == 1) & F.col("back")[0].isNotNull() & (F.get("back", F.lit(0))["role"] == F.col("role")) & (F.get("back", F.lit(0))["text"] == F.col("text"))
    # a text with "###" is never left as it is, header or not
    clear = same & (F.instr("role", "###") == 0) & (F.instr("text", "###") == 0)
    return back.withColumn("clear", F.coalesce(clear, F.lit(False))).select(
        "conv_id", "turn", "role", "text",
        F.when(F.col("clear"), F.col("role")).otherwise(escape_role(F.col("role"))).alias("shown_role"),
        F.when(F.col("clear"), F.col("text")).otherwise(escape(F.col("text"))).alias("shown"))


def format_chats(rows: DataFrame) -> DataFrame:
    """conv_id, formatted text, loss spans (start and end in code points, of assistant texts) and `identical` of every conversation (conv_id, turn, role, text)."""
    turns = _turns(rows)
    piece = render(F.col("shown_role"), F.col("shown"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("piece", piece).withColumn("at", F.coalesce(F.sum(F.char_length("piece").cast("long")).over(order), F.lit(0).cast("long")))
    start = F.col("at") + len(HEAD) + F.char_length("shown_role") + len(MIDDLE)
    span = F.when(F.col("role") == LEARNT, F.struct(start.alias("start"), (start + F.char_length("shown")).alias("end")))
    grouped = placed.withColumn("span", span).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "piece", "role", "text"))).alias("t"), F.sort_array(F.collect_list("span")).alias("spans"))
    out = grouped.withColumn("formatted", F.array_join("t.piece", "")).withColumn("back", parse(F.col("formatted")))
    same = F.transform("back", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))) == F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    return out.select("conv_id", "formatted", "spans", F.coalesce(same, F.lit(False)).alias("identical"))


def chat_digest(rows: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations: turns, text under the loss mask, sizes and checksums."""
    chats = format_chats(rows).withColumn("turns", parse(F.col("formatted")))
    masked = F.transform("spans", lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    out = chats.withColumn("loss", F.array_join(masked, ""))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
