r"""Chat formatting with a grammar round trip (operator 8). DataFrame functions only.

Grammar of a formatted conversation::

    conversation := "<s>" turn*
    turn := "<<SYS>>" text "<</SYS>>"            role system
          | "[INST] " text " [/INST]"            role user
          | " " text "</s>"                      role assistant
          | "[ROLE:" role "]" text "[/ROLE]"     any other role

Inside ``text`` (and ``role``) a backslash starts an escape: ``\e`` is a
backslash, ``\l`` is ``<``, ``\b`` is ``[`` and ``\r`` is ``]``; every other
character stands for itself.

Each turn is rendered verbatim and parsed by the grammar again. Where the
parse differs from the source, the turn's control strings and backslashes are
escaped; where that still differs, all of ``<``, ``[``, ``]`` and ``\`` are,
after which no control string can occur inside. Whole conversations are
parsed once more and must give back their source, else the job fails.

``format_conversations`` returns the formatted text with the spans of the loss
mask (the assistant texts); ``read_back`` recovers turns and loss text from those
alone. Defined cases: a null text or role is empty; a null turn comes first;
rows that share conv_id and turn are ordered by role, then text; repeated rows
are turns of their own; a null conv_id is one conversation; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candela.llm.store import fitted

# fixed values: the control strings of the template
BEGIN = "<s>"
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>")}
OTHER, OTHER_NAMED, OTHER_END = "[ROLE:", "]", "[/ROLE]"

#: one turn; the text is the first non-empty group of 1, 2, 3 and 5, the name of another role is 4
TURN = (r"(?s)<<SYS>>(.*?)<</SYS>>|\[INST\] (.*?) \[/INST\]| (.*?)</s>"
        r"|\[ROLE:([^\]]*)\](.*?)\[/ROLE\]")
CONTROL_ANGLE = r"<(?=/?s>|</?SYS>>)"
CONTROL_SQUARE = r"\[(?=/?INST\]|/?ROLE)"


def _replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def unescape(c: Column) -> Column:
    for code, char in (("\\l", "<"), ("\\b", "["), ("\\r", "]"), ("\\e", "\\")):
        c = _replace(c, code, char)
    return c


def escape_controls(c: Column) -> Column:
    c = _replace(c, "\\", "\\e")
    c = F.regexp_replace(c, CONTROL_ANGLE, r"\\l")
    return F.regexp_replace(c, CONTROL_SQUARE, r"\\b")


def escape_all(c: Column) -> Column:
    for code, char in (("\\e", "\\"), ("\\l", "<"), ("\\b", "["), ("\\r", "]")):
        c = _replace(c, char, code)
    return c


def _render(role: Column, text: Column) -> Column:
    out = F.concat(F.lit(OTHER), escape_all(role), F.lit(OTHER_NAMED), text, F.lit(OTHER_END))
    for name, (before, after) in MARKS.items():
        out = F.when(role == name, F.concat(F.lit(before), text, F.lit(after))).otherwise(out)
    return out


def _opening(role: Column) -> Column:
    """Code points before the text of a rendered turn."""
    out = F.length(escape_all(role)) + len(OTHER) + len(OTHER_NAMED)
    for name, (before, _) in MARKS.items():
        out = F.when(role == name, F.lit(len(before))).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit(len(OTHER_END))
    for name, (_, after) in MARKS.items():
        out = F.when(role == name, F.lit(len(after))).otherwise(out)
    return out


def _pieces(formatted: Column) -> Column:
    return F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))


def _parsed(piece: Column) -> Column:
    """(role, text) of the rendered turn ``piece``."""
    named = F.regexp_extract(piece, r"^\[ROLE:([^\]]*)\]", 1)
    role = F.when(F.startswith(piece, F.lit(OTHER)), unescape(named))
    start = F.when(F.startswith(piece, F.lit(OTHER)), F.length(named) + len(OTHER) + len(OTHER_NAMED))
    end = F.when(F.startswith(piece, F.lit(OTHER)), F.lit(len(OTHER_END)))
    for name, (before, after) in MARKS.items():
        mine = F.startswith(piece, F.lit(before))
        role, start, end = (role.when(mine, F.lit(name)), start.when(mine, F.lit(len(before))),
                            end.when(mine, F.lit(len(after))))
    text = F.substring(piece, start + 1, F.length(piece) - start - end)
    return F.struct(role.alias("role"), unescape(text).alias("text"))


def _round_trip(role: Column, text: Column, rendered: Column, pieces: Column) -> Column:
    back = _parsed(pieces[0])
    return ((F.size(pieces) == 1) & (F.length(pieces[0]) == F.length(rendered))
            & (back["role"] == role) & (back["text"] == text))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask, for conv_id, turn, role, text. The mask
    has an entry for each turn: null, or for an assistant's the code points in
    ``formatted`` where the turn and its text start and the text ends."""
    turns = (fitted(conversations, conv_id="long", turn="long", role="string", text="string")
             .fillna("", ["role", "text"]))
    role, text = F.col("role"), F.col("text")
    turns = (turns.withColumn("tried", _render(role, text)).withColumn("found", _pieces(F.col("tried")))
             .withColumn("tried", F.when(_round_trip(role, text, F.col("tried"), F.col("found")), F.col("tried"))
                         .otherwise(_render(role, escape_controls(text))))
             .withColumn("found", _pieces(F.col("tried")))
             .withColumn("rendered", F.when(_round_trip(role, text, F.col("tried"), F.col("found")), F.col("tried"))
                         .otherwise(_render(role, escape_all(text)))))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    size = F.length("rendered")
    turns = (turns.withColumn("nth", F.row_number().over(order))
             .withColumn("at", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size + len(BEGIN)))
    span = F.when(role == "assistant", F.struct(
        F.col("at"), (F.col("at") + _opening(role)).alias("start"), (F.col("at") + size - _closing(role)).alias("end")))
    turns = turns.select("conv_id", F.struct("nth", "rendered", "role", "text", span.alias("span")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    formatted = F.concat(F.lit(BEGIN), F.array_join(F.col("ts.rendered"), ""))
    source = F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    mask = F.transform("ts", lambda t: t["span"])
    whole = whole.select("conv_id", formatted.alias("formatted"), source.alias("source"), mask.alias("loss_mask"))
    same = F.transform(_pieces(F.col("formatted")), _parsed) == F.col("source")
    return whole.select("conv_id", F.when(same, F.col("formatted"))
                        .otherwise(F.raise_error(F.lit("a conversation does not parse back"))).alias("formatted"),
                        "loss_mask")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text), loss_text: from formatted and loss_mask alone."""
    # cut from the turn, not from the whole: positions in a string are found by counting
    loss = F.zip_with(_pieces(F.col("formatted")), "loss_mask", lambda p, s: unescape(
        F.substring(p, (s["start"] - s["at"]).cast("int") + 1, (s["end"] - s["start"]).cast("int"))))
    return formatted.select("conv_id", "formatted",
                            F.transform(_pieces(F.col("formatted")), _parsed).alias("turns"),
                            F.array_join(loss, "").alias("loss_text"))


def digests(formatted: DataFrame) -> DataFrame:
    back = read_back(formatted)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


#: both texts of conversation -1 in the registered query
CONFLICT = "</s>[INST] ok [/INST]"

ORACLE_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
    SELECT *,
        CASE role WHEN 'system' THEN '<<SYS>>' WHEN 'user' THEN '[INST] ' WHEN 'assistant' THEN ' '
            ELSE '[ROLE:' || replace(replace(replace(replace(role, '\', '\e'), '<', '\l'), '[', '\b'), ']', '\r') || ']' END AS opening,
        CASE role WHEN 'system' THEN '<</SYS>>' WHEN 'user' THEN ' [/INST]' WHEN 'assistant' THEN '</s>'
            ELSE '[/ROLE]' END AS closing,
        replace(replace(replace(replace(text, '\l', '<'), '\b', '['), '\r', ']'), '\e', '\') = text AS plain
    FROM turns),
sized AS (
    SELECT *, length(opening) + length(closing) + length(
        CASE WHEN plain AND strpos(text || closing, closing) = length(text) + 1 THEN text
        ELSE regexp_replace(regexp_replace(regexp_replace(replace(text, '\', '\e'),
            '<(/?s>)', '\\l\1', 'g'), '<(</?SYS>>)', '\\l\1', 'g'), '\[(/?INST\]|/?ROLE)', '\\b\1', 'g') END) AS size
    FROM marked)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(size))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
