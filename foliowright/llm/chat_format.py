"""Chat formatting: role checks by a finite-state machine, escaped texts, loss mask.

Native: DataFrame functions only. One exchange gathers each conversation's turns (a
conversation is one output row, so its turns must meet); all else is row-local.

Order: turn, then role, then text; repeated rows stay. A null text or role is empty, a
null turn comes first, and a null conv_id is a conversation of its own. Extra columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longest first, so that no code is cut by another when it is read back.
_ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"), ("\n", "~3"))


@dataclass(frozen=True)
class Template:
    """A chat template: how a turn opens and closes, which roles bear loss, who may follow whom.

    Control strings start with "<" or "[", which escaped texts don't hold.
    """

    open_role: str = "<|"
    close_role: str = "|>\n"
    end: str = "</s>"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state -> role -> next state; a missing entry is an error
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "ready", "user": "asked"},
            "ready": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )
    final: tuple[str, ...] = ("answered",)


def escape(text: Column, lines: bool = False) -> Column:
    """Text without "<" and "[" (and, if lines, without line breaks); unescape() undoes it."""
    for raw, code in _ESCAPES[: 4 if lines else 3]:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column, lines: bool = False) -> Column:
    for raw, code in reversed(_ESCAPES[: 4 if lines else 3]):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def walk(roles: Column, template: Template) -> Column:
    """The state the machine is in behind the roles; null from the first error on."""
    step = F.create_map(*[F.lit(x) for state, moves in template.moves.items() for role, to in moves.items() for x in (f"{state} {role}", to)])
    return F.aggregate(roles, F.lit("start"), lambda state, role: F.try_element_at(step, F.concat(state, F.lit(" "), role)))


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, valid, segments (text and loss flag, in order) and formatted, a row per conversation."""
    turn = F.struct(F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    chats = turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    quiet = lambda x: F.struct(x.alias("text"), F.lit(False).alias("loss"))

    def segments(t: Column) -> Column:
        head = F.concat(F.lit(template.open_role), escape(t["role"], lines=True), F.lit(template.close_role))
        body = F.struct(escape(t["text"]).alias("text"), t["role"].isin(*template.loss_roles).alias("loss"))
        return F.array(quiet(head), body, quiet(F.lit(template.end)))

    out = chats.select(
        "conv_id",
        F.coalesce(walk(F.transform("turns", lambda t: t["role"]), template).isin(*template.final), F.lit(False)).alias("valid"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
    )
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """Array of (role, text), from the formatted string alone."""
    blocks = F.split(formatted, rf"\Q{template.end}\E", -1)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def one(block: Column) -> Column:
        inner = F.substr(block, F.lit(len(template.open_role) + 1))
        at = F.instr(inner, template.close_role)
        return F.struct(
            unescape(F.substr(inner, F.lit(1), at - 1), lines=True).alias("role"),
            unescape(F.substr(inner, at + len(template.close_role))).alias("text"),
        )

    return F.transform(blocks, one)


def digest(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """What can be read back from formatted chats: turns, and texts under the loss mask."""
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    back = chats.select("conv_id", "valid", "formatted", read_turns(F.col("formatted"), template).alias("turns"), loss.alias("loss"))
    nl = F.lit("\n")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], nl, t["text"], nl)), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


#: The result for the default template, in DuckDB SQL.
SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^~<\[]', '', 'g')) + length(role)
    + length(regexp_replace(role, '[^~<\[' || chr(10) || ']', '', 'g')) + 9 AS chars,
    CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END AS r
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  regexp_full_match(string_agg(r, '' ORDER BY turn NULLS FIRST, role, text), 's?(ua)+') AS valid
FROM marked GROUP BY conv_id
"""
