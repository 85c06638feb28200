"""Chat formatting into budgeted training windows, in DataFrame functions only.

The turns of a conversation are ordered by (turn, role, text), nulls first. Prefix sums of their
token counts lay them on a line that is cut into cells of half the capacity (budget less system turn
and history). Turns that start in a cell form a window; a turn longer than a cell starts last in
its cell and gets a window of its own. So windows are aligned to turns and within the budget, unless
a single turn exceeds it; such windows are marked, never cut.

Every window opens with the system turn (the conversation's first row, if its role is ``system``)
and repeats the turns that lie whole within ``history`` tokens before it. The loss mask covers each
assistant text once: repeated turns are masked. Sums run over chunks of ``CHUNK`` turn numbers and
then over chunk totals, so that no long conversation is summed in one task.

Control strings inside roles and texts get a backslash after their first character, one more than
they had, which ``unescape`` takes away again. Null texts and roles are empty; null conversation ids
are one conversation; repeated rows are repeated turns.
"""

from pyspark.sql import DataFrame, Window, functions as F

from delaylens.llm.common import stored

BUDGET = 1024
HISTORY = 128
CHUNK = 64
#: Tokens counted for the marks of a turn.
OVERHEAD = 4
#: Template of a turn: OPEN role MID text CLOSE.
OPEN, MID, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
_CONTROL = r"(/?(?:s>|INST\]))"


def token_count(text):
    """Tokens of a text: one for each run of up to four visible characters."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]{1,4}")).cast("long")


def escape(text):
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(text):
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, r"$1$2$3")


def _placed(turns, chunk):
    """Rows with their number, prefix sum and the facts of their conversation."""
    rows = turns.withColumn("chunk", F.floor(F.col("turn") / chunk))
    inside = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    rows = rows.select(
        "*", (F.row_number().over(inside) - 1).alias("nth"),
        F.coalesce(F.sum("cost").over(inside.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("so_far"))
    first = F.min(F.struct("turn", "role", "text", "cost")).alias("first")
    chunks = turns.withColumn("chunk", F.floor(F.col("turn") / chunk)).groupBy(
        "conv_id", "chunk").agg(F.sum("cost").alias("total"), F.count("*").alias("n"), first)
    order = Window.partitionBy("conv_id").orderBy("chunk")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    system = F.first("first").over(order.rowsBetween(Window.unboundedPreceding, 0))
    chunks = chunks.select(
        F.col("conv_id").alias("own_conv"), F.col("chunk").alias("own_chunk"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
        F.when(system["role"] == "system", system["cost"]).alias("system_cost"))
    joined = rows.join(chunks, rows.conv_id.eqNullSafe(chunks.own_conv)
                       & rows.chunk.eqNullSafe(chunks.own_chunk))
    at = F.col("n_before") + F.col("nth")
    is_system = (at == 0) & F.col("system_cost").isNotNull()
    start = F.col("before") + F.col("so_far") - F.coalesce("system_cost", F.lit(0))
    return joined.select("conv_id", "role", "text", "cost", "system_cost", at.alias("at"),
                         is_system.alias("is_system"),
                         F.when(is_system, F.lit(0)).otherwise(start).alias("start"))


def format_chats(conversations: DataFrame, budget=BUDGET, history=HISTORY, chunk=CHUNK,
                 cost=token_count) -> DataFrame:
    """``conv_id, window, formatted, loss, n_tokens, repeated, over_budget`` per window.

    ``window`` orders the windows of a conversation; ``loss`` lists (start, length) in code points
    of ``formatted``; ``repeated`` is the number of leading turns that earlier windows have too.
    """
    text = F.coalesce("text", F.lit(""))
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"),
        (cost(text) + OVERHEAD).cast("long").alias("cost"))
    placed = _placed(turns, chunk)
    capacity = F.greatest(F.lit(budget - history) - F.coalesce("system_cost", F.lit(0)),
                          F.lit(max(2, budget // 4)))
    half = F.floor(capacity / 2)
    cell = F.floor(F.col("start") / half)
    own = F.when(F.col("is_system"), F.lit(0)).otherwise(
        cell * 2 + (F.col("cost") > half).cast("long"))
    placed = stored(placed.withColumn("half", half).withColumn("window", own), "turns")
    windows = placed.groupBy("conv_id", "window").agg(F.min("start").alias("begin"))
    fresh = placed.withColumn("is_repeat", F.lit(False))

    names = windows.select(F.col("conv_id").alias("w_conv"), F.col("window").alias("w"), "begin")
    # only keys meet the windows; a turn that is longer than the history is never repeated
    near = placed.where(~F.col("is_system") & (F.col("cost") <= history)).select(
        F.col("conv_id").alias("h_conv"), F.col("at").alias("h_at"), "start", "window",
        F.explode(F.sequence(F.col("window"), F.floor(
            (F.col("start") + history) / F.col("half")) * 2 + 1)).alias("to")).where("to > window")
    near = near.join(names, near.h_conv.eqNullSafe(names.w_conv) & (near["to"] == names.w)).where(
        F.col("begin") <= F.col("start") + history).select("h_conv", "h_at", "to")
    old = placed.join(near, placed.conv_id.eqNullSafe(near.h_conv) & (placed["at"] == near.h_at)).select(
        *[c for c in placed.columns if c != "window"], F.col("to").alias("window"),
        F.lit(True).alias("is_repeat"))
    head = placed.where("is_system")
    head = head.select(F.col("conv_id").alias("s_conv"), *[c for c in head.columns if c not in (
        "conv_id", "window")]).join(names.where("w > 0"), F.expr("s_conv <=> w_conv")).select(
        F.col("s_conv").alias("conv_id"), *[c for c in placed.columns if c not in (
            "conv_id", "window")], F.col("w").alias("window"), F.lit(True).alias("is_repeat"))
    rows = fresh.unionByName(old).unionByName(head)

    lead = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MID))
    part = F.struct(
        "at", lead.alias("lead"), escape(F.col("text")).alias("body"),
        (~F.col("is_repeat") & (F.col("role") == "assistant")).alias("is_target"),
        F.col("is_repeat").cast("int").alias("old"), "cost")
    parts = rows.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    tail = CLOSE + END
    step = F.aggregate(
        "parts", F.struct(F.lit(0).alias("pos"), F.expr(
            "cast(array() as array<struct<start:int,length:int>>)").alias("loss")),
        lambda acc, p: F.struct(
            (acc["pos"] + F.length(p["lead"]) + F.length(p["body"]) + len(tail)).alias("pos"),
            F.when(p["is_target"], F.concat(acc["loss"], F.array(F.struct(
                (acc["pos"] + F.length(p["lead"])).alias("start"),
                F.length(p["body"]).alias("length"))))).otherwise(acc["loss"]).alias("loss")),
        lambda acc: acc["loss"])
    tokens = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, p: acc + p["cost"])
    return parts.select(
        "conv_id", "window",
        F.array_join(F.transform("parts", lambda p: F.concat(p["lead"], p["body"], F.lit(tail))),
                     "").alias("formatted"),
        step.alias("loss"), tokens.alias("n_tokens"),
        F.aggregate("parts", F.lit(0), lambda acc, p: acc + p["old"]).alias("repeated"),
        (tokens > budget).alias("over_budget"))


def read_chats(windows: DataFrame) -> DataFrame:
    """Per window: its new ``turns`` (role, text) and the unescaped texts under the loss mask."""
    pieces = F.split("formatted", END, -1)
    pieces = F.slice(pieces, F.col("repeated") + 1, F.size(pieces) - F.col("repeated") - 1)
    role = lambda p: F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), MID, 1)
    skip = lambda p: F.length(role(p)) + len(OPEN) + len(MID)
    body = lambda p: F.substr(p, skip(p) + 1, F.length(p) - skip(p) - len(CLOSE))
    return windows.select(
        "conv_id", "window",
        F.transform(pieces, lambda p: F.struct(
            unescape(role(p)).alias("role"), unescape(body(p)).alias("text"))).alias("turns"),
        F.transform("loss", lambda s: unescape(F.substr(
            F.col("formatted"), s["start"] + 1, s["length"]))).alias("learnt"),
        F.length("formatted").cast("long").alias("n_chars"))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from the windows: its turns, learnt text and formatted size."""
    read = read_chats(windows).select(
        "conv_id", F.struct(
            "window", F.size("turns").cast("long").alias("n"),
            F.array_join(F.transform("turns", lambda t: F.concat(
                t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("spoken"),
            F.array_join("learnt", "").alias("learnt"), "n_chars").alias("w"))
    whole = read.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("w")).alias("w"), F.sum("w.n").alias("n_turns"),
        F.sum("w.n_chars").alias("formatted_chars"))
    learnt = F.array_join(F.transform("w", lambda w: w["learnt"]), "")
    return whole.select(
        "conv_id", "n_turns",
        F.sha2(F.array_join(F.transform("w", lambda w: w["spoken"]), ""), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"), "formatted_chars")


ORACLE = rf"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
    (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) AS v(conv_id, turn, role, text)),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]{{1,4}}')) + {OVERHEAD} AS cost FROM c),
o AS (SELECT *, row_number() OVER w - 1 AS pos, sum(cost) OVER w - cost AS total,
    first_value(CASE WHEN role = 'system' THEN cost END) OVER w AS sys
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
p AS (SELECT *, (pos = 0 AND sys IS NOT NULL) AS is_sys,
    CASE WHEN pos = 0 AND sys IS NOT NULL THEN 0 ELSE total - coalesce(sys, 0) END AS start,
    greatest({BUDGET - HISTORY} - coalesce(sys, 0), {BUDGET // 4}) // 2 AS half FROM o),
q AS (SELECT *, CASE WHEN is_sys THEN 0 ELSE start // half * 2 + (cost > half)::INT END AS win,
    length(regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g'))
    + length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g'))
    + {len(OPEN + MID + CLOSE + END)} AS chars FROM p),
w AS (SELECT conv_id, win, min(start) AS start FROM q GROUP BY ALL),
again AS (SELECT w.conv_id, sum(chars) AS chars FROM w JOIN q ON q.conv_id = w.conv_id
    AND q.win < w.win AND (q.is_sys OR w.start <= q.start + {HISTORY}) GROUP BY ALL),
per AS (SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '') AS learnt
  FROM q GROUP BY conv_id)
SELECT per.conv_id, n_turns, turns_sha256, length(learnt) AS loss_chars,
  sha256(learnt) AS loss_sha256, CAST(per.chars + coalesce(again.chars, 0) AS BIGINT) AS formatted_chars
FROM per LEFT JOIN again ON per.conv_id = again.conv_id"""
