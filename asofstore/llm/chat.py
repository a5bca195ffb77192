"""Chat formatting with a grammar round trip (operator 5), DataFrame functions only.

Grammar of a formatted conversation::

    conversation := turn*
    turn         := "[INST]" role "[/INST]" text "</s>"

where role and text hold none of the three control strings. Each turn is first
rendered as it is, parsed again and compared with its source; a turn that does
not come back identical (control strings in it, or something that looks like
an escape) is rendered with backslash, ``[`` and ``<`` escaped, which no text
survives as a control string, and compared again. The whole conversation is
parsed once more at the end; a difference is an error, not a row.

``loss`` says which text bears loss: per turn, the place of the text inside that
turn (null where it bears none), so reading it back is linear in the
conversation's length.

Defined results: null role and null text are empty; turns are ordered by turn
(null first), then role, then text; repeated rows are repeated turns; a null
conv_id is one conversation; no rows give no conversations; extra columns are
ignored. A conversation is one text and is gathered as such.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings and escapes.
OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
ESCAPES = (("\\", "\\b"), ("[", "\\l"), ("<", "\\a"))


def escape(x: Column) -> Column:
    for plain, code in ESCAPES:
        x = F.replace(x, F.lit(plain), F.lit(code))
    return x


def unescape(x: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        x = F.replace(x, F.lit(code), F.lit(plain))
    return x


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(CLOSE), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation;
    null in place of a turn that the grammar does not allow."""
    return F.transform(_bodies(formatted), _turn)


def _bodies(formatted: Column) -> Column:
    """What stands before each END; a last part without END is kept, so that
    it fails as a turn."""
    parts = F.split(formatted, END.replace("/", "\\/"), -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def _turn(body: Column) -> Column:
    rest = F.substr(body, F.lit(len(OPEN) + 1))
    role = F.substring_index(rest, CLOSE, 1)
    text = F.substr(rest, F.length(role) + len(CLOSE) + 1)
    ok = (F.startswith(body, F.lit(OPEN)) & F.contains(rest, F.lit(CLOSE)) & ~F.contains(role, F.lit(OPEN))
          & ~F.contains(text, F.lit(OPEN)) & ~F.contains(text, F.lit(CLOSE)))
    return F.when(ok, F.struct(unescape(role).alias("role"), unescape(text).alias("text")))


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """conv_id, n_turns, formatted, loss (per turn null or start and length, in
    code points, from 0), n_escaped."""
    t = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("_turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("_role"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    one = F.struct(F.col("_role").alias("role"), F.col("_text").alias("text"))
    plain = F.coalesce(parse(render(F.col("_role"), F.col("_text"))) == F.array(one), F.lit(False))
    t = t.withColumn("_plain", plain).withColumns({
        "_r": F.when(F.col("_plain"), F.col("_role")).otherwise(escape(F.col("_role"))),
        "_x": F.when(F.col("_plain"), F.col("_text")).otherwise(escape(F.col("_text")))})
    whole = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("_turn", "_role", "_text", "_plain", "_r", "_x"))).alias("_t"))
    loss = F.transform("_t", lambda x: F.when(x["_role"] == loss_role, F.struct(
        (F.length(x["_r"]) + len(OPEN + CLOSE)).alias("start"), F.length(x["_x"]).alias("length"))))
    out = whole.select(
        "conv_id", F.size("_t").cast("long").alias("n_turns"),
        F.array_join(F.transform("_t", lambda x: render(x["_r"], x["_x"])), "").alias("formatted"),
        loss.alias("loss"), F.size(F.filter("_t", lambda x: ~x["_plain"])).alias("n_escaped"),
        F.transform("_t", lambda x: F.struct(x["_role"].alias("role"), x["_text"].alias("text"))).alias("_source"))
    same = F.coalesce(parse(F.col("formatted")) == F.col("_source"), F.lit(False))
    checked = F.when(same, F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("conversation does not come back from its format: "),
                               F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
    return out.select("conv_id", "n_turns", checked.alias("formatted"), "loss", "n_escaped")


def digests(formatted: DataFrame) -> DataFrame:
    """Turns and loss text read back from ``formatted`` and ``loss``."""
    spoken = F.transform(parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    bodies = formatted.withColumn("_spoken", spoken)
    under = F.array_join(F.zip_with(_bodies(F.col("formatted")), F.col("loss"), lambda b, s: F.when(
        s.isNotNull(), unescape(F.substr(b, s["start"] + 1, s["length"]))).otherwise("")), "")
    return bodies.withColumn("_loss", under).select(
        "conv_id", F.size("_spoken").cast("long").alias("n_turns"),
        F.sha2(F.array_join("_spoken", ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
