"""Chat formatting, structure repair and the filter audit against plain versions on planted cases."""

import hashlib
import itertools
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanworks.llm import chat, filter_audit, repair
from gleanworks.llm.queries import ORACLES, QUERIES
from gleanworks.session import table

CHATS = "conv_id long, turn long, role string, text string"
ODD = ["", " ", "a", "[INST]", r"[\INST]", r"[\\INST] <s>", "</s>[INST] ok [/INST]", "[[/INST]", "<</s>", "é [SYS", "SYS]", "[/ROLE] ", "\n", "\\", "$1", "[OUT] x </s>\n"]


def chats(spark, said, **more):
    return spark.createDataFrame(said, CHATS).withColumns({k: F.lit(v) for k, v in more.items()})


def test_turns_come_back_from_the_marks(spark):
    rnd, rows = random.Random(5), []
    for conv in range(40):
        for turn in range(rnd.randrange(1, 9)):
            rows.append((conv, turn, rnd.choice(["system", "user", "assistant", "tool", "[ROLE]", "", "a\nb"]), "".join(rnd.choices(ODD, k=rnd.randrange(4)))))
    rows.append((100, 0, "user", "x" * 300_000 + "[INST]" * 1000))
    rows += [(102, i, "user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(600)]
    out = chat.formatted_chats(chats(spark, rows, segments="mine", formatted="mine", row="mine"))
    got = {r["conv_id"]: r for r in out.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.learnt_text(F.col("segments")).alias("learnt")).collect()}
    for conv, own in itertools.groupby(sorted(rows, key=lambda r: r[:2]), key=lambda r: r[0]):
        own, r = list(own), got[conv]
        assert [(t["role"], t["text"]) for t in r["turns"]] == [x[2:] for x in own]
        assert r["learnt"] == "".join(x[3] for x in own if x[2] == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        state, taken = "start", 0
        for x in own:
            state = chat.GRAMMAR.get(state, {}).get(x[2], "refused")
            taken += state != "refused"
        assert (r["valid"], r["accepted"]) == (state == "answered", taken)
    assert got[102]["valid"] and got[102]["accepted"] == 600


def test_chat_cases(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, 1, None, "x"), (None, None, "user", "null id"), (None, 3, "assistant", "b")]
    got = {r["conv_id"]: r for r in chat.formatted_chats(chats(spark, rows)).select("*", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("user", ""), ("user", ""), ("", "x")] and not got[1]["valid"]
    assert [tuple(t) for t in got[None]["turns"]] == [("user", "null id"), ("assistant", "b")] and got[None]["valid"]
    assert chat.formatted_chats(chats(spark, [])).count() == 0
    own = {"bot": {"open": "<bot>", "close": "<end>", "loss": True}}
    r = chat.formatted_chats(chats(spark, [(1, 0, "bot", "a<end>b")]), template=own, grammar={"start": {"bot": "done"}}, accepting=("done",)).first()
    assert r["formatted"] == r"<bot>a<\end>b<end>" and r["valid"]
    with pytest.raises(ValueError, match="a mark is"):
        chat.control_strings({"bot": {"open": "bot:", "close": "<end>", "loss": True}})


def test_chat_format_stays_in_the_jvm(spark, sf_dir):
    plan = QUERIES["op11_chat_format"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1


def edits_by_hand(rows, most):
    """The least (cost, audit) over all edit strings of at most `most` characters."""
    best = None
    for size in range(len(rows), most + 1):
        for audit in itertools.product("DIKR", repeat=size):
            if sum(e != "I" for e in audit) != len(rows):
                continue
            i, cost, made = 0, 0, ""
            for e in audit:
                # The role of a made turn: the one that can follow.
                own = "a" if made[-1:] == "u" else "u"
                if e == "I":
                    cost, made = cost + 2, made + own
                    continue
                initial, fault = rows[i]
                i += 1
                if e == "D":
                    cost += 3
                    continue
                if fault in ("blank", "duplicate"):
                    break
                cost += (fault == "truncated") + 2 * (e == "R")
                made += own if e == "R" else (initial or "?")
            else:
                legal = made[1:] if made[:1] == "s" else made
                if (made == "" or legal) and legal == "ua" * (len(legal) // 2) and (best is None or (cost, "".join(audit)) < best):
                    best = (cost, "".join(audit))
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "x", ""]), st.sampled_from([None, None, "blank", "duplicate", "truncated"])), max_size=4))
def test_search_by_hand(rows):
    # A cheapest repair never inserts more turns than it has rows, and one more for an odd end.
    found = repair.search(rows, 0, repair.ACCEPTING)
    assert len(found) == 1 and next(iter(found.values())) == edits_by_hand(rows, 2 * len(rows) + 1)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["a.", "b!", "c", "", " ", "d."])), max_size=40), st.integers(1, 6))
def test_spans_change_nothing(rows, span):
    def report():
        talk = repair.Conversation()
        for turn, row in enumerate(rows):
            talk.add(turn, *row)
        return talk.report()

    whole, usual = report(), repair.SPAN
    try:
        repair.SPAN = span
        assert report() == whole
    finally:
        repair.SPAN = usual


def test_repair_cases(spark):
    rows = [
        (1, 0, "user", "q?"), (1, 0, "user", "q?"), (1, 4, "assistant", "a"), (2, None, None, None), (None, 1, "user", "hm."),
        (3, 7, "assistant", "late."), (4, -(2**62), "user", "x."), (4, 2**62, "assistant", "y."), (5, 0, "system", "only."),
    ]
    out = {r["conv_id"]: r for r in repair.repaired(chats(spark, rows, audit="mine", times="mine", conv="mine")).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    told = lambda c: tuple(out[c][k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
    assert told(1) == (3, 0, 1, 1, 1, 4, "KDK", digest("user:q?\nassistant:a"))
    assert told(2) == (0, 1, 0, 0, 0, 3, "D", digest(""))
    assert told(None) == (0, 0, 0, 0, 0, 2, "KI", digest("user:hm.\nassistant:"))
    assert told(3) == (0, 0, 0, 0, 0, 2, "IK", digest("user:\nassistant:late."))
    assert told(4)[:1] == (2**63 - 1,) and told(5)[5:7] == (3, "D")
    assert repair.repaired(chats(spark, [])).count() == 0
    gone = repair.repaired(chats(spark, rows), times=F.lit(0)).collect()
    assert len(gone) == 6 and {tuple(r)[1:] for r in gone} == {(0, 0, 0, 0, 0, 0, "", digest(""))}


def test_a_long_conversation_is_streamed(spark):
    n = 6000
    df = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "assistant").otherwise("user").alias("role"), F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(".")).alias("text"))
    r = repair.repaired(df).first()
    roles = ["assistant" if i % 3 == 0 else "user" for i in range(n)]
    # Layer by layer over all rows at once.
    best = {0: 0}
    for role in roles:
        grown = dict(best)
        for _ in range(2):
            for g, c in list(grown.items()):
                to = repair.MADE[g][1]
                grown[to] = min(grown.get(to, c + 2), c + 2)
        new = {}
        for g, c in grown.items():
            for to, more in ((g, 3), (repair.MADE[g][1], 2), *([(repair.GRAMMAR[g][role[0]], 0)] if role[0] in repair.GRAMMAR[g] else [])):
                new[to] = min(new.get(to, c + more), c + more)
        best = new
    assert r["cost"] == min(best.get(0, 10**9), best.get(3, 10**9), best.get(2, 10**9) + 2)
    assert sum(e != "I" for e in r["audit"]) == n


def test_damage(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").collect()
    got = {(r["conv_id"], r["turn"]): r for r in repair.damaged(table(spark, sf_dir, "conversations")).collect()}
    for r in rows:
        kind, d = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20, got[r["conv_id"], r["turn"]]
        text = "" if kind == 1 else r["text"].translate({ord(c): None for c in ".!?"}) if kind == 2 else r["text"]
        assert (d["role"], d["text"], d["times"]) == ("user" if kind == 4 else r["role"], text, {0: 0, 3: 2}.get(kind, 1))


def audit_by_hand(docs, labels):
    good, toxic = ({d for d, q, t in labels if (q, t)[i] == 1} for i in (0, 1))
    fails = []
    for d, text, source in docs:
        text = text or ""
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
        flags = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), bool(set(text) & set("#$%&*|")), d is not None and any(e is not None and e < d and (t or "") == text for e, t, _ in docs)]
        fails.append((source or "", {f for f, x in zip("ABCDE", flags) if x}, d in good, d in toxic))
    rows = {}
    for part in {p for p, *_ in fails}:
        own, sums = [x for x in fails if x[0] == part], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                out = [x for x in left if f in x[1]]
                bad = [x for x in own if f in x[1]]
                left = [x for x in left if f not in x[1]]
                sums[f] += len(out)
                rows[part, "".join(order), step] = [len(left), len(out), len(bad) - len(out), sum(x[1] == {f} for x in own), sum(x[2] for x in out), sum(x[3] for x in out)]
        for (p, order, step), r in rows.items():
            if p == part:
                r.append(sums[order[step - 1]])
    return rows


NAMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_filter_audit_by_hand(spark):
    rnd = random.Random(3)
    pool = ["", None, "short text", "Loud TEXT HERE", "a | b", " ".join(f"w{i}" for i in range(60)), "same word " * 40, "word\x0bword\x0cword " * 20, " ".join(f"é{i}#" for i in range(50)), " ".join(f"w{i}" for i in range(60)), " ".join(str(i) for i in range(20_000))]
    docs = [(rnd.choice([None, *range(30)]), rnd.choice(pool), rnd.choice([None, "", "s1", "s2"])) for _ in range(120)]
    labels = [(rnd.choice([None, *range(40)]), rnd.choice([None, 0, 1]), rnd.choice([None, 0, 1])) for _ in range(30)]
    frames = (spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({c: F.lit("mine") for c in ("digest", "A", "n", "part", "id", "good")}), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = filter_audit.flagged(*frames)
    assert found.count() == len(docs)
    got = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in NAMES] for r in filter_audit.audited(found).collect()}
    assert got == audit_by_hand(docs, labels)
    assert filter_audit.audited(filter_audit.flagged(frames[0].limit(0), frames[1].limit(0))).count() == 0


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} >= {f"op{i}" for i in (1, 2, 3, 4, 6, 8, 9, 10, 11, 12, 13)} and {"op11_chat_format", "op12_structure_repair", "op13_filter_audit"} <= set(ORACLES)
