"""Conversations as training text: turns checked by a finite-state machine, segments with loss flags.

A template names for each role the marks around a turn and whether the turn's text is learnt; a
grammar names for each state the roles it takes. Both are plain dictionaries. Every mark that the
template can write is a control string; one inside a text gets a backslash after its first
character, one that has backslashes there gets one more, so that nothing in a text reads as a mark
and the texts come back exactly. No control string holds its first character again, so none can
arise where a text meets a mark.

All of it is built-in functions: rows are escaped where they lie, shuffled once, and a conversation
becomes a row. A conversation is one training text, so it has to fit in a row; that is the only
group that meets in a task.

Rows go by turn (null first), ties by role and then by escaped text; repeated rows are all kept. A
null text or role counts as an empty one, roles without a template are written by name, null
conversation ids form one conversation. Turns that the grammar refuses are written like all
others; `valid` and `accepted` (turns up to the first refused one) tell. Other columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanworks.session import table

TEMPLATE = {
    "system": {"open": "[SYS] ", "close": " [/SYS]\n", "loss": False},
    "user": {"open": "[INST] ", "close": " [/INST]\n", "loss": False},
    "assistant": {"open": "[OUT] ", "close": "</s>\n", "loss": True},
}
#: Any other role, by name between two marks.
OTHER = {"open": "[ROLE]", "named": "[/ROLE] ", "close": "</s>\n"}
#: Strings of common formats that no text may hold either.
GUARDED = ("<s>", "</s>", "[INST]", "[/INST]")
GRAMMAR = {
    "start": {"system": "briefed", "user": "asked"},
    "briefed": {"user": "asked"},
    "asked": {"assistant": "answered"},
    "answered": {"user": "asked"},
}
ACCEPTING = ("answered",)
REFUSED = "refused"


def control_strings(template: dict) -> list[str]:
    """The marks that the template can write, without the space around them, and GUARDED."""
    marks = {m.strip() for t in [*template.values(), OTHER] for k, m in t.items() if k != "loss"} | set(GUARDED)
    if bad := [m for m in marks if len(m) < 2 or m[0] not in "[<" or set(m[1:]) & set("[<\\")]:
        raise ValueError(f"a mark is [ or < and no further of these or backslash: {bad}")
    return sorted(marks)


def _tails(template: dict) -> str:
    return "|".join(re.escape(t) for t in sorted({m[1:] for m in control_strings(template)}))


def escaped(c: Column, template: dict = TEMPLATE) -> Column:
    return F.regexp_replace(c, rf"([\[<])(\\*)({_tails(template)})", r"$1\\$2$3")


def unescaped(c: Column, template: dict = TEMPLATE) -> Column:
    return F.regexp_replace(c, rf"([\[<])\\(\\*)({_tails(template)})", "$1$2$3")


def _looked_up(pairs: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv)), key)


def walked(roles: Column, grammar: dict = GRAMMAR) -> Column:
    """struct(state, accepted): the machine's last state over an array of roles, and how many it took."""
    steps = {f"{s} {r}": to for s, by in grammar.items() for r, to in by.items()}
    start = F.struct(F.lit(next(iter(grammar))).alias("state"), F.lit(0).cast("long").alias("accepted"))

    def step(at: Column, role: Column) -> Column:
        state = F.coalesce(_looked_up(steps, F.concat(at["state"], F.lit(" "), role)), F.lit(REFUSED))
        return F.struct(state.alias("state"), (at["accepted"] + (state != REFUSED).cast("long")).alias("accepted"))

    return F.aggregate(roles, start, step)


def formatted_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", template: dict = TEMPLATE, grammar: dict = GRAMMAR, accepting: tuple = ACCEPTING) -> DataFrame:
    """(conv, segments array<struct<text, loss>>, formatted, valid, accepted): a row a conversation."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = df.select(F.col(conv).alias("conv"), F.struct(F.col(turn).alias("turn"), said(role).alias("role"), escaped(said(text), template).alias("body")).alias("row"))
    chats = rows.groupBy("conv").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def segments(r: Column) -> Column:
        of = lambda key: _looked_up({k: t[key] for k, t in template.items()}, r["role"])
        named = F.concat(F.lit(OTHER["open"]), escaped(r["role"], template), F.lit(OTHER["named"]))
        texts = (F.coalesce(of("open"), named), r["body"], F.coalesce(of("close"), F.lit(OTHER["close"])))
        flags = (F.lit(False), F.coalesce(of("loss"), F.lit(False)), F.lit(False))
        return F.array(*(F.struct(t.alias("text"), f.alias("loss")) for t, f in zip(texts, flags)))

    out = chats.select("conv", walked(F.transform("rows", lambda r: r["role"]), grammar).alias("end"), F.flatten(F.transform("rows", segments)).alias("segments"))
    valid = F.col("end.state").isin(*accepting)
    return out.select(F.col("conv").alias(conv), "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), valid.alias("valid"), F.col("end.accepted").alias("accepted"))


def read_turns(formatted: Column, template: dict = TEMPLATE) -> Column:
    """array<struct<role, text>>: the turns of a formatted text, found by its marks alone."""
    opens = "|".join(re.escape(t["open"]) for t in template.values())
    name = f"{re.escape(OTHER['open'])}.*?{re.escape(OTHER['named'])}"
    closes = "|".join(re.escape(m) for m in sorted({t["close"] for t in [*template.values(), OTHER]}))
    pattern = F.lit(f"(?s)({opens}|{name})(.*?)({closes})")
    marks, bodies = F.regexp_extract_all(formatted, pattern, 1), F.regexp_extract_all(formatted, pattern, 2)

    def turn(mark: Column, body: Column) -> Column:
        own = F.substring(mark, F.lit(len(OTHER["open"]) + 1), F.length(mark) - len(OTHER["open"] + OTHER["named"]))
        role = F.coalesce(_looked_up({t["open"]: r for r, t in template.items()}, mark), unescaped(own, template))
        return F.struct(role.alias("role"), unescaped(body, template).alias("text"))

    return F.zip_with(marks, bodies, turn)


def learnt_text(segments: Column, template: dict = TEMPLATE) -> Column:
    """The text under the loss flags, unescaped a segment at a time."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"], template)), "")


#: The planted conversation: both of its turns are made of control strings.
PLANTED_ID, PLANTED_TEXT = -7, "</s>[INST] ok [/INST]"


def op11_chat_format(spark, sf_dir):
    """All conversations and the planted one, formatted; turns and learnt text are read back from the output."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(PLANTED_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED_TEXT).alias("text")
    )
    chats = formatted_chats(rows.unionByName(planted))
    back = chats.select("*", read_turns(F.col("formatted")).alias("turns"), learnt_text(F.col("segments")).alias("learnt"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
        "valid", "accepted",
    )


#: From the rules alone: a control string in a text costs one character, the marks of a turn are constant by role.
OP11_SQL = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
    SELECT *, CASE role WHEN 'system' THEN 'S' WHEN 'user' THEN 'U' WHEN 'assistant' THEN 'A' ELSE 'X' END AS mark,
        length(text) + len(regexp_extract_all(text, '[\[<]\\*(/?(?:SYS|INST|ROLE)\]|OUT\]|/?s>)'))
        + CASE role WHEN 'system' THEN 14 WHEN 'user' THEN 16 WHEN 'assistant' THEN 11
            ELSE 19 + length(role) + len(regexp_extract_all(role, '[\[<]\\*(/?(?:SYS|INST|ROLE)\]|OUT\]|/?s>)')) END AS chars
    FROM said),
chats AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS told,
        coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS learnt,
        sum(chars)::BIGINT AS formatted_chars, string_agg(mark, '' ORDER BY turn) AS marks
    FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars,
    regexp_full_match(marks, 'S?(UA)+') AS valid, length(regexp_extract(marks, '^(SU|U|S$)?(AU)*A?', 0)) AS accepted
FROM chats
"""
