"""Chat formatting by a declarative template, with a role machine and loss flags.

A conversation becomes segments of text, each with a flag that tells whether a
model is trained on it: a header, the escaped text and a close mark per turn.
Control strings of the template cannot occur inside an escaped text, so the
turns are read back by plain splitting. Only DataFrame expressions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmill.llm.shared import text_of


@dataclass(frozen=True)
class Template:
    """labels: header names of the roles; others are written after `other`. trained: roles under the loss mask.

    order: the roles that may follow a state, which is "" at the start and then
    the last role; ends: the states in which a conversation may end.
    """

    labels: tuple[tuple[str, str], ...] = (("system", "System"), ("user", "User"), ("assistant", "Assistant"))
    trained: tuple[str, ...] = ("assistant",)
    open: str = "### "
    after: str = ":\n"
    close: str = "</turn>\n"
    other: str = "?"
    order: tuple[tuple[str, tuple[str, ...]], ...] = (("", ("system", "user")), ("system", ("user",)), ("user", ("assistant",)), ("assistant", ("user",)))
    ends: tuple[str, ...] = ("user", "assistant")

    def __post_init__(self):
        for mark in self.controls:
            # A backslash between its first two characters must take a mark out of any text.
            if len(mark) < 2 or "\\" in mark[:2] or (mark[0] == mark[1] and mark[:3] != mark[0] * 3):
                raise ValueError(f"{mark!r} can't be escaped")

    @property
    def controls(self) -> tuple[str, ...]:
        return self.open, self.close, self.after


DEFAULT = Template()
# A conversation of the template's own marks, formatted along with the table's.
PROBE = r"\### Assistant: </turn> ok"


def escaped(text: Column, template: Template = DEFAULT) -> Column:
    """Backslashes are doubled; one goes between the first two characters of each control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in template.controls:
        text = F.replace(text, F.lit(mark[:2]), F.lit(f"{mark[0]}\\{mark[1]}"))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _strings(values) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def formatted(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row for each conversation of `turns` (conv_id, turn, role, text): conv_id, segments, valid.

    segments: array of (text, loss) in order. valid: the role machine accepts
    the turns. Rows go by turn, then by role and text; a null role is the empty
    one, a null text empty. A conversation is one row, as its readers need it.
    """
    labels = F.create_map(*[F.lit(x) for pair in template.labels for x in pair])
    label = F.coalesce(labels[F.col("role")], F.concat(F.lit(template.other), escaped(F.col("role"), template)))
    segments = F.array(
        F.struct(F.concat(F.lit(template.open), label, F.lit(template.after)).alias("text"), F.lit(False).alias("loss")),
        F.struct(escaped(F.col("text"), template).alias("text"), F.array_contains(_strings(template.trained), F.col("role")).alias("loss")),
        F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")))
    clean = turns.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), text_of().alias("text"))
    rows = F.sort_array(F.collect_list(F.struct("turn", "role", "text", segments.alias("segments"))))
    whole = clean.groupBy("conv_id").agg(rows.alias("rows"))

    moves = F.create_map(*[x for state, roles in template.order for x in (F.lit(state), _strings(roles))])
    step = lambda state, row: F.when(F.coalesce(F.array_contains(moves[state], row["role"]), F.lit(False)), row["role"])
    end = F.aggregate("rows", F.lit(""), step)
    return whole.select(
        "conv_id", F.flatten(F.transform("rows", lambda r: r["segments"])).alias("segments"),
        F.coalesce(F.array_contains(_strings(template.ends), end), F.lit(False)).alias("valid"))


def whole_text(segments: str = "segments") -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_back(text: Column, template: Template = DEFAULT) -> Column:
    """Array of (role, text) from a formatted conversation."""
    roles = F.create_map(*[F.lit(x) for role, label in template.labels for x in (label, role)])
    parts = F.split(text, "(?:" + "".join(f"\\x{{{ord(c):x}}}" for c in template.close) + ")", -1)

    def turn(part: Column) -> Column:
        label = F.substring_index(part, template.after, 1)
        name = F.substring(label, F.lit(len(template.open) + 1), F.length(label))
        role = F.coalesce(roles[name], unescaped(F.substring(name, F.lit(len(template.other) + 1), F.length(name))))
        body = F.substring(part, F.length(label) + len(template.after) + 1, F.length(part))
        return F.struct(role.alias("role"), unescaped(body).alias("text"))

    # Behind the last close mark there is nothing.
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def trained_text(segments: str = "segments") -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def digests(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row for each conversation: what is read back from its formatted text and its loss mask.

    Cases: rows with a null conv_id are one conversation; an unknown role keeps
    its name and makes the conversation invalid; a null turn comes first; an
    empty table gives no rows; further columns are ignored.
    """
    made = formatted(turns, template).select("conv_id", "valid", whole_text().alias("formatted"), trained_text().alias("trained"))
    back = made.withColumn("turns", read_back(F.col("formatted"), template))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def with_probe(turns: DataFrame) -> DataFrame:
    """The turns and conversation -7, a user and an assistant that say the probe."""
    probe = turns.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.element_at(F.array(F.lit("user"), F.lit("assistant")), F.col("id").cast("int") + 1).alias("role"),
        F.lit(PROBE).alias("text"))
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe)


ORACLE_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
  SELECT *,
    replace(replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</', '<\/'), ':' || chr(10), ':\' || chr(10)) AS body,
    replace(replace(replace(replace(role, '\', '\\'), '##', '#\#'), '</', '<\/'), ':' || chr(10), ':\' || chr(10)) AS name
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(6 + CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role) ELSE 1 + length(name) END + length(body) + 8) AS BIGINT) AS formatted_chars,
  regexp_full_match(string_agg(role, ',' ORDER BY turn, role, text), '(system,)?user(,assistant,user)*(,assistant)?') AS valid
FROM escaped GROUP BY conv_id
"""
