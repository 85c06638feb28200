"""Chat formatting and benchmark decontamination: DataFrame functions only."""

import pytest

from delaylens.llm import chat, decontam
from tests.llm.helpers import SCHEMA, bench_hits, documents, prose, sha

TURNS = "conv_id long, turn long, role string, text string"
TRICKY = ["</s>[INST] ok [/INST]", r"<\s> <\\s> [\INST]", "<s", "[/INST", "", None, "a\nb", "<<s>>",
          r"\<s>", "ends with <", "[[INST]"]


def turns():
    import random
    rng = random.Random(4)
    rows = [(1, k, ["user", "assistant"][k % 2], TRICKY[k % len(TRICKY)]) for k in range(40)]
    rows += [(2, 0, "system", "rules"), (2, 1, "user", "hi"), (2, 2, "assistant", "x" * 9000),
             (2, 3, "system", "late"), (2, 4, "assistant", "end")]
    rows += [(3, 0, "system", "alone"), (4, None, None, "no turn"), (4, 0, "assistant", "yes"),
             (None, 0, "user", "q"), (None, 1, "assistant", "a"), (5, 0, "assistant", "twice"),
             (5, 0, "assistant", "twice"), (6, 0, "user", "only")]
    rows += [(7, k, ["user", "assistant"][k % 2], " ".join(prose(rng, rng.randint(1, 60))))
             for k in range(300)]
    return rows


def in_order(rows):
    none = lambda x: (x is not None, x if x is not None else 0)
    return sorted(rows, key=lambda r: (none(r[1]), r[2] or "", r[3] or ""))


@pytest.mark.parametrize("budget,history", [(1024, 128), (60, 20), (40, 0), (64, 64)])
def test_formats_and_reads_back(spark, budget, history):
    rows = turns()
    df = spark.createDataFrame(rows, TURNS).withColumnRenamed("x", "x")
    windows = chat.format_chats(df, budget, history, chunk=8)
    got = {r.conv_id: r for r in chat.digests(windows).collect()}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert set(got) == set(by)
    for conv, mine in by.items():
        mine = in_order(mine)
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        learnt = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        g = got[conv]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == (
            len(mine), sha(said), len(learnt), sha(learnt))
    for w in windows.collect():
        assert w.over_budget == (w.n_tokens > budget)
        if w.over_budget:  # only because of one turn, or of a system turn
            assert w.formatted.count(chat.OPEN) - w.repeated <= 2
        if w.conv_id == 2 and w.window > 0:
            assert w.formatted.startswith("<s>system[INST]rules")


def test_history_is_repeated_and_masked(spark):
    rows = [(1, k, ["user", "assistant"][k % 2], f"word{k:04d}" * 4) for k in range(30)]
    windows = sorted(chat.format_chats(spark.createDataFrame(rows, TURNS), 100, 30).collect(),
                     key=lambda w: w.window)
    assert len(windows) > 3 and all(w.repeated for w in windows[1:]) and not windows[0].repeated
    learnt = [w.formatted[s.start:s.start + s.length] for w in windows for s in w.loss]
    assert learnt == [r[3] for r in rows if r[2] == "assistant"]


def test_empty_conversations(spark):
    assert chat.digests(chat.format_chats(spark.createDataFrame([], TURNS))).count() == 0


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in TRICKY if t is not None], "t string")
    for t, e, u in df.select("t", chat.escape("t").alias("e"),
                             chat.unescape(chat.escape("t")).alias("u")).collect():
        assert u == t and not any(m in e for m in (chat.OPEN, chat.MID, chat.CLOSE, chat.END))


@pytest.mark.parametrize("broadcast_rows", [decontam.BROADCAST_ROWS, 0])
def test_decontamination(spark, broadcast_rows):
    rows = documents()
    words = (rows[15][1] or "").split()
    items = [(1, " ".join(words[5:30])), (2, " ".join(words[10:20]).upper()), (3, "one"),
             (4, "x, Two!"), (5, None), (6, "..."), (None, " ".join(words[40:52])),
             (1, "same id again " + " ".join(words[60:70])), (10, " ".join(["tick"] * 14)),
             (11, "Grün ñandú été 中文"), (12, " ".join(words[30:36])), (13, "absent words here")]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "N_hit").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.decontaminate(df, bench, broadcast_rows=broadcast_rows).collect()
    assert len(got) == len(rows)
    for r in got:
        n, hit, listed = bench_hits(r.text, items)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
            n, hit, len(listed), sha(",".join(listed)), hit > 0)
    assert decontam.decontaminate(df.limit(0), bench, broadcast_rows=broadcast_rows).count() == 0
    clean = decontam.decontaminate(df, bench.limit(0), broadcast_rows=broadcast_rows).collect()
    assert len(clean) == len(rows) and not any(r.contaminated or r.n_items for r in clean)


@pytest.mark.parametrize("broadcast_rows", [decontam.BROADCAST_ROWS, 0])
def test_decontamination_joins_without_texts(spark, broadcast_rows):
    """Where the result drops the texts, no side of its join has them; names like its own pass through."""
    df = spark.createDataFrame([(1, "a b c", 5, 6), (2, "", 7, 8)], "doc_id long, text string, th int, N int")
    bench = spark.createDataFrame([(1, "b C")], "item_id long, text string")
    got = decontam.decontaminate(df, bench, broadcast_rows=broadcast_rows)
    assert [tuple(r)[:7] for r in got.orderBy("doc_id").collect()] == [
        (1, "a b c", 5, 6, 3, 2, 1), (2, "", 7, 8, 0, 0, 0)]
    nodes, joins = [got.drop("text")._jdf.queryExecution().optimizedPlan()], 0
    for node in nodes:
        below = [node.children().apply(i) for i in range(node.children().size())]
        nodes += below
        if node.nodeName() == "Join":
            joins += 1
            assert not any("text#" in x.output().mkString(",") for x in below)
    assert joins
