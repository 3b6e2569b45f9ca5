r"""Operator 9, chat formatting: a role machine and a declarative template.

The template names, for each role, the text that opens and closes a turn and
whether the turn's text carries loss. A finite-state machine over the roles
(transitions given as data) says whether the turn order is valid and where it
first breaks. Each turn becomes three segments (open, text, close) with a loss
flag each; the formatted conversation is their concatenation.

Escaping: in texts (and in the names of roles that the template does not know)
every backslash is doubled, then a backslash is put after the first character
of every control string. No control string is left in an escaped text, so the
output can be cut at the markers, and ``unescape`` restores the text exactly: a
backslash followed by another stands for one, any other backslash is dropped.

Only DataFrame functions are used. A conversation is one output row, so its
turns are gathered by conversation; nothing is gathered across conversations.

Defined results: a null text or role counts as empty. Turns are ordered by turn
number (null first), then role, then text, so ties and repeated rows have one
order; every row is a turn. Rows with a null conversation id form one
conversation with a null id. Roles outside the template are formatted with the
fallback marks, without loss, and make the order invalid. An empty table gives
no rows. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import cut, let, table


@dataclass(frozen=True)
class Turn:
    """How one role's turns look."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    turns: dict[str, Turn]
    # Any other role: open, the escaped role name, name_end, the text, close.
    fallback: Turn
    name_end: str
    # state -> role -> next state; a missing entry is an invalid turn order.
    machine: dict[str, dict[str, str]]
    start: str = "start"
    # states in which a conversation may end
    final: tuple[str, ...] = ()
    extra_controls: tuple[str, ...] = field(default=())

    def marks(self) -> list[str]:
        every = [*self.turns.values(), self.fallback]
        found = [x.strip() for t in every for x in (t.open, t.close)] + [self.name_end.strip()]
        return list(dict.fromkeys([*found, *self.extra_controls]))


# The default template, in the style of instruction-tuned chat models.
INSTRUCT = Template(
    turns={
        "system": Turn("<<SYS>> ", " <</SYS>>"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("<s> ", " </s>", loss=True),
    },
    fallback=Turn("[ROLE] ", " [/ROLE]"),
    name_end=" [:] ",
    machine={
        "start": {"system": "briefed", "user": "asked"},
        "briefed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    },
    final=("answered",),
)


def escape(text: Column, template: Template) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in template.marks():
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _state_after(turns: Column, template: Template) -> Column:
    """The machine's last state and the number of valid turns; "" once a turn was invalid."""
    step = F.create_map(*[F.lit(x) for state, row in template.machine.items()
                          for role, to in row.items() for x in (f"{state}>{role}", to)])
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("n"))

    def advance(acc: Column, t: Column) -> Column:
        to = F.coalesce(F.try_element_at(step, F.concat(acc["state"], F.lit(">"), t["role"])), F.lit(""))
        return F.struct(to.alias("state"), (acc["n"] + F.when(to != "", 1).otherwise(0)).alias("n"))

    return F.aggregate(turns, begin, advance)


def format_conversations(rows: DataFrame, template: Template = INSTRUCT, conv: str = "conv_id",
                         turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, valid, valid_turns, segments``.

    ``segments`` is an array of ``(text, loss)``; the formatted conversation is
    the concatenation of the texts.
    """
    turns = rows.select(
        F.col(conv).alias("conv_id"),
        F.struct(F.col(turn).cast("long").alias("turn"),
                 F.coalesce(F.col(role), F.lit("")).alias("role"),
                 F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(t: Column) -> Column:
        body = escape(t["text"], template)
        known = t["role"].isin(list(template.turns))

        def pick(get, default) -> Column:
            out = None
            for name, look in template.turns.items():
                hit = t["role"] == name
                out = F.when(hit, get(look)) if out is None else out.when(hit, get(look))
            return out.otherwise(default)

        fb = template.fallback
        named = F.concat(F.lit(fb.open), escape(t["role"], template), F.lit(template.name_end))
        opened = pick(lambda x: F.lit(x.open), named)
        closed = pick(lambda x: F.lit(x.close), F.lit(fb.close))
        loss = known & pick(lambda x: F.lit(x.loss), F.lit(False))
        seg = lambda s, flag: F.struct(s.alias("text"), flag.alias("loss"))
        return F.array(seg(opened, F.lit(False)), seg(body, loss), seg(closed, F.lit(False)))

    end = _state_after(F.col("turns"), template)
    return grouped.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        end.alias("end"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
    ).select(
        "conv_id", "n_turns",
        F.col("end.state").isin(list(template.final)).alias("valid"),
        F.col("end.n").cast("long").alias("valid_turns"), "segments")


def _quoted(mark: str) -> str:
    return "".join("\\" + c if c in r"\^$.|?*+()[]{}/" else c for c in mark)


def parse_formatted(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Turns and loss text read back from ``format_conversations`` output.

    Adds ``formatted`` (the whole string), ``turns`` (array of role and text,
    recovered from the string alone by its markers) and ``loss_text`` (the text
    under the loss mask, unescaped).
    """
    opens = {t.open: r for r, t in template.turns.items()}
    every = [*template.turns.values(), template.fallback]
    pattern = ("(?s)(" + "|".join(_quoted(t.open) for t in every) + ")(.*?)("
               + "|".join(_quoted(t.close) for t in every) + ")")
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    marked = formatted.withColumn("formatted", whole)
    roles = F.create_map(*[F.lit(x) for kv in opens.items() for x in kv])

    def turn(opened: Column, body: Column) -> Column:
        other = F.split(body, _quoted(template.name_end), 2)
        is_other = opened == template.fallback.open
        return F.struct(
            unescape(F.when(is_other, F.get(other, F.lit(0))).otherwise(F.try_element_at(roles, opened))).alias("role"),
            unescape(F.when(is_other, F.get(other, F.lit(1))).otherwise(body)).alias("text"))

    found = lambda g: F.regexp_extract_all("formatted", F.lit(pattern), F.lit(g))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")
    return marked.withColumn("turns", F.zip_with(found(1), found(2), turn)).withColumn("loss_text", loss)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and conversation -7, formatted, written and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
        "conv_id long, turn long, role string, text string")
    back = parse_formatted(cut(format_conversations(rows.unionByName(added)), "chat"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid", "valid_turns")


_MARKS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[:]"]


def _escaped_sql(col: str) -> str:
    out = f"replace({col}, '\\', '\\\\')"
    for m in _MARKS:
        out = f"replace({out}, '{m}', '{m[0]}\\{m[1:]}')"
    return out


OP9_SQL = f"""
WITH c AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (SELECT conv_id, turn, role, text,
             lag(role) OVER w AS before, row_number() OVER w AS pos,
             CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
                  ELSE 21 + length({_escaped_sql('role')}) END + length({_escaped_sql('text')}) AS chars
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (SELECT *, (before IS NULL AND role IN ('system', 'user')) OR (before IN ('system', 'assistant') AND role = 'user')
                OR (before = 'user' AND role = 'assistant') AS fits FROM s),
g AS (SELECT *, bool_and(fits) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS fine FROM f)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars,
       bool_and(fits) AND arg_max(role, pos) = 'assistant' AS valid,
       count(*) FILTER (fine) AS valid_turns
FROM g GROUP BY conv_id
"""
