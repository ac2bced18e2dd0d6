"""Least edits that make a conversation's turn order legal, by Dijkstra's algorithm.

A node of the lattice is (rows consumed, grammar state); its edges keep, rerole or delete the next
row or insert an empty turn. The frontier's key is (cost, audit), the audit being the initials of
the edits so far, so of equally cheap repairs the ASCII-least audit wins; the search stops at the
first accepting end node that it pops. Costs never fall along a path and two audits of one node and
cost never are a prefix of one another (the longer one would have paid for an insertion), so the
first time a node is popped its label is final.

Rows are dealt by conversation, sorted by turn and read as a stream; no conversation is gathered.
A task holds 16 bytes a row for the duplicates, one audit and one running hash for each of the four
states, and SPAN rows: a longer conversation is solved span by span, from each state that the spans
before can reach, and labels are added up. That is the same search with the lattice's columns
entered one span at a time; the result doesn't depend on SPAN.

Rows go by turn (null first), ties by role and text. A null conversation id is a conversation of its
own; null roles and texts are one space, so such a text is blank, and a role without a legal initial
has to be reroled or deleted. Repeated rows are duplicates. A conversation without rows costs
nothing. gaps stops at 2^63 - 1. Other columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanworks.llm.common import groups
from gleanworks.session import table

#: State -> (initial, next state) of the turns it takes: start, after the system, user and assistant turn.
GRAMMAR = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Of those, what an edit makes: (role, next state).
MADE = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
ACCEPTING = frozenset((0, 3))
LEGAL = frozenset(("su", "ua", "au"))
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FAULTS = ("blank", "duplicate", "truncated")
SPAN = 256
GROUP_BYTES = 1 << 20
#: Strings, as words split at these only.
_VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def search(rows: list[tuple[str, str | None]], start: int, ends: frozenset[int] | None) -> dict[int, tuple[int, str]]:
    """{state: (cost, audit)} of the least labels at the end of rows of (role initial, fault), from `start`.

    With `ends`, only the first popped end node in them; with None every end state."""
    n, frontier, settled, found = len(rows), [(0, "", 0, start)], set(), {}
    while frontier:
        cost, audit, i, state = heapq.heappop(frontier)
        if (i, state) in settled:
            continue
        settled.add((i, state))
        if i == n:
            if ends is None or state in ends:
                found[state] = (cost, audit)
                if ends is not None:
                    break
        else:
            initial, fault = rows[i]
            heapq.heappush(frontier, (cost + DELETE, audit + "D", i + 1, state))
            if fault not in FAULTS[:2]:
                left = cost + TRUNCATED * (fault == "truncated")
                if initial in GRAMMAR[state]:
                    heapq.heappush(frontier, (left, audit + "K", i + 1, GRAMMAR[state][initial]))
                heapq.heappush(frontier, (left + REROLE, audit + "R", i + 1, MADE[state][1]))
        heapq.heappush(frontier, (cost + INSERT, audit + "I", i, MADE[state][1]))
    return found


def replayed(rows: list[tuple[str, str]], audit: str, state: int) -> Iterator[str]:
    """The `role:text` lines that an audit makes of (role, text) rows."""
    i = 0
    for edit in audit:
        if edit == "I":
            yield MADE[state][0] + ":"
        elif edit == "R":
            yield f"{MADE[state][0]}:{rows[i][1]}"
        elif edit == "K":
            yield f"{rows[i][0]}:{rows[i][1]}"
        if edit == "K":
            state = GRAMMAR[state][rows[i][0][:1]]
        elif edit != "D":
            state = MADE[state][1]
        i += edit != "I"


class Conversation:
    """The running report of one conversation; rows come in order."""

    def __init__(self) -> None:
        self.seen, self.counts, self.illegal, self.before = set(), dict.fromkeys(FAULTS, 0), 0, None
        self.turns, self.first, self.last = 0, None, None
        self.rows: list[tuple[str, str]] = []
        self.judged: list[tuple[str, str | None]] = []
        #: state -> (cost, audit, hash of the repaired lines, whether there are any)
        self.paths = {0: (0, "", hashlib.sha256(), False)}

    def add(self, turn: int | None, role: str, text: str) -> None:
        if len(self.rows) == SPAN:
            self._advance(None)
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        if not _VISIBLE.search(text):
            fault = "blank"
        elif key in self.seen:
            fault = "duplicate"
        else:
            fault = None if text.rstrip(_SPACE)[-1] in ".!?" else "truncated"
        self.seen.add(key)
        if fault:
            self.counts[fault] += 1
        if turn is not None and turn != self.last:
            self.turns, self.first, self.last = self.turns + 1, turn if self.first is None else self.first, turn
        self.illegal += self.before is not None and self.before + role[:1] not in LEGAL
        self.before = role[:1]
        self.rows.append((role, text))
        self.judged.append((role[:1], fault))

    def _advance(self, ends: frozenset[int] | None) -> None:
        """Solves the rows held and puts them behind."""
        reached = {}
        for start, (cost, audit, _, _) in self.paths.items():
            for end, (more, own) in search(self.judged, start, ends).items():
                reached.setdefault(end, []).append((cost + more, audit + own, start, own))
        new = {}
        for end, labels in reached.items():
            cost, audit, start, own = min(labels)
            digest, some = self.paths[start][2].copy(), self.paths[start][3]
            for line in replayed(self.rows, own, start):
                digest.update(("\n" * some + line).encode())
                some = True
            new[end] = (cost, audit, digest, some)
        self.paths, self.rows, self.judged = new, [], []

    def report(self) -> dict:
        self._advance(ACCEPTING)
        cost, audit, digest, _ = min(self.paths.values(), key=lambda p: p[:2])
        gaps = min(self.last - self.first + 1 - self.turns, 2**63 - 1) if self.turns else 0
        return {"gaps": gaps, **self.counts, "illegal": self.illegal, "cost": cost, "audit": audit, "repaired_sha256": digest.hexdigest()}


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repaired(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", times: Column | None = None) -> DataFrame:
    """(conv, REPORT): a row a conversation. times: how often a row counts, 0 leaving only its conversation."""
    times = F.lit(1) if times is None else times
    held = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), held(role).alias("role"), F.when(times > 0, held(text)).alias("text"), times.cast("int").alias("times")
    )
    kind = dict(rows.dtypes)["conv"]

    def reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now, talk, schema = [], None, None, None
        for batch in batches:
            schema = schema or pa.schema([batch.schema.field("conv"), *((f.split()[0], pa.int64() if f.endswith("long") else pa.string()) for f in REPORT.split(", "))])
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for part in groups(sizes, GROUP_BYTES):
                columns = [batch.column(c).slice(part.start, part.stop - part.start).to_pylist() for c in ("conv", "turn", "role", "text", "times")]
                for c, turn_, role_, text_, n in zip(*columns):
                    if talk is None or c != now:
                        if talk is not None:
                            done.append({"conv": now, **talk.report()})
                            if len(done) == 1000:
                                yield pa.RecordBatch.from_pylist(done, schema)
                                done = []
                        now, talk = c, Conversation()
                    for _ in range(n):
                        talk.add(turn_, role_, text_)
        if talk is not None:
            yield pa.RecordBatch.from_pylist([*done, {"conv": now, **talk.report()}], schema)

    dealt = rows.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    return dealt.mapInArrow(reports, f"conv {kind}, {REPORT}").withColumnRenamed("conv", conv)


def damaged(df: DataFrame) -> DataFrame:
    """conversations with planted faults and `times`, by crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its text, 2 takes its `[.!?]`, 3 repeats it, 4 makes it the user's."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text, role = told("text"), told("role")
    return df.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


def op12_structure_repair(spark, sf_dir):
    """The damaged conversations' faults and their cheapest repairs."""
    return repaired(damaged(table(spark, sf_dir, "conversations")), times=F.col("times"))


#: A layer of rows a step: labels of four states, an edge for each edit, at most two insertions between rows. CRC-32 bit by bit.
OP12_SQL = r"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (
    SELECT *, (4294967295 - list_reduce(list_concat([4294967295::BIGINT],
        list_transform(range(0, 8 * length(k)), lambda i: ((ascii(substring(k, (i // 8 + 1)::BIGINT, 1)) >> (i % 8)::INTEGER) & 1)::BIGINT)),
        lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384))) % 20 AS kind FROM keyed),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM kinds),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM damaged),
judged AS (
    SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
        CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault
    FROM placed),
totals AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id),
inserts(g, h, more, edits, made) AS (VALUES (0, 0, 0, '', ['']), (1, 1, 0, '', ['']), (2, 2, 0, '', ['']), (3, 3, 0, '', ['']),
    (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']), (3, 2, 2, 'I', ['user:']),
    (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:']), (2, 2, 4, 'II', ['assistant:', 'user:'])),
edits(g, initial, edit, h, more) AS (
    SELECT g, NULL, 'D', g, 3 FROM range(4) AS s(g)
    UNION ALL VALUES (0, 's', 'K', 1, 0), (0, 'u', 'K', 2, 0), (1, 'u', 'K', 2, 0), (2, 'a', 'K', 3, 0), (3, 'u', 'K', 2, 0)
    UNION ALL VALUES (0, NULL, 'R', 2, 2), (1, NULL, 'R', 2, 2), (2, NULL, 'R', 3, 2), (3, NULL, 'R', 2, 2)),
walk AS (
    SELECT conv_id, 0::BIGINT AS i, 0 AS g, {'cost': 0::BIGINT, 'audit': '', 'made': []::VARCHAR[]} AS label FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, i, g, min(label) FROM (
        SELECT w.conv_id, r.i, e.h AS g, {'cost': w.label.cost + n.more + e.more + CASE WHEN r.fault = 'truncated' AND e.edit <> 'D' THEN 1 ELSE 0 END,
            'audit': w.label.audit || n.edits || e.edit,
            'made': list_concat(w.label.made, list_filter(n.made, lambda x: x <> ''), CASE e.edit WHEN 'D' THEN []
                WHEN 'K' THEN [r.role || ':' || r.text] WHEN 'R' THEN [CASE e.h WHEN 2 THEN 'user:' ELSE 'assistant:' END || r.text] END)} AS label
        FROM walk w JOIN judged r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
            JOIN inserts n ON n.g = w.g JOIN edits e ON e.g = n.h AND (e.edit <> 'K' OR e.initial = r.initial)
                AND (e.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate'))) AS steps
    GROUP BY conv_id, i, g),
ended AS (
    SELECT w.conv_id, min({'cost': w.label.cost + n.more, 'audit': w.label.audit || n.edits, 'made': list_concat(w.label.made, list_filter(n.made, lambda x: x <> ''))}) AS label
    FROM walk w LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM w.conv_id JOIN inserts n ON n.g = w.g AND n.h IN (0, 3)
    WHERE w.i = coalesce(t.n, 0) GROUP BY w.conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, e.label.cost AS cost, e.label.audit AS audit, sha256(coalesce(array_to_string(e.label.made, chr(10)), '')) AS repaired_sha256
FROM ended e LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM e.conv_id
"""
