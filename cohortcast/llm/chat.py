"""Chat formatting in budgeted windows.

A conversation's turns become windows of a token budget, each a text in one
template with a loss mask.  Prefix sums of the turns' tokens choose the spans:
a window takes whole turns while their sum stays within its room.  The system
turn, when it opens the conversation, leads every window, and a few turns
before the span are repeated as history.  Repeated turns are never targets, so
each assistant turn is learned from once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortcast.llm.common import staged

# ---------------------------------------------------------------------------
# The template.
# ---------------------------------------------------------------------------
START, END = "<|im_start|>", "<|im_end|>"
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"

#: Tokens of a window, of the history in it, turns of the history, and tokens
#: that the template adds to a turn.
BUDGET, HISTORY_TOKENS, HISTORY_TURNS, TURN_TOKENS = 512, 128, 4, 4


def escape(text: Column) -> Column:
    """Breaks every ``<|`` by a backslash, after those that stand there: no
    control string is left, and :func:`unescape` restores the text."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    """As :func:`escape`, with the line end that closes a role in the template."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_windows(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS,
                   history_turns: int = HISTORY_TURNS) -> DataFrame:
    """``(id_col, window, n_repeated, n_turns, n_tokens, formatted, loss)``:
    the windows of every conversation, numbered from 0.

    ``loss`` lists (start, end) code points of ``formatted`` to learn from;
    the first ``n_repeated`` of a window's turns stand in an earlier one.

    * A null text or role counts as empty; null turn numbers come first; equal
      turn numbers are ordered by role, then text; repeated rows are turns.
    * A null id is a conversation of its own.
    * A turn longer than the room has a window to itself, whole; a system turn
      longer than the budget still leads every window.
    * Other columns are not read; an empty table gives no window.

    Spans are cut from the turns' numbers and token counts alone (some 24 bytes
    a turn in one row for each conversation); texts meet in the row of their
    window, never of their conversation.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text_col, role_col))
    rows = turns.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    tokens = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + TURN_TOKENS
    order = W.partitionBy("id").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, 0)
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    told = staged(rows.withColumn("tokens", tokens).select(
        "id", F.row_number().over(W.partitionBy("id").orderBy("turn", "role", "text")).alias("nth"),
        F.sum("tokens").over(order).alias("upto"), "tokens", head.alias("head"), escape(F.col("text")).alias("body"),
        (F.col("role") == TARGET_ROLE).alias("target"), (F.col("role") == SYSTEM_ROLE).alias("system")), "chat-turns")
    conv = told.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("nth", "upto", "tokens", "system"))).alias("turns"))
    # The first turn, if it is the system's, leads; spans are cut from the rest.
    lead = F.when(F.get("turns", 0)["system"], F.slice("turns", 1, 1)).otherwise(F.slice("turns", 1, 0))
    conv = conv.withColumn("lead", lead)
    lead_tokens = F.coalesce(F.get("lead", 0)["tokens"], F.lit(0))
    room = F.greatest(F.lit(budget - history_tokens) - lead_tokens, F.lit(1))
    conv = conv.withColumn("room", room).withColumn("skip", F.size("lead"))
    cut = lambda acc, t: F.struct(  # noqa: E731  a turn that passes the room opens the next span
        F.when(t["upto"] - acc["base"] > F.col("room"), t["upto"] - t["tokens"]).otherwise(acc["base"]).alias("base"),
        F.when(t["upto"] - acc["base"] > F.col("room"), F.concat(acc["at"], F.array(t["nth"])))
        .otherwise(acc["at"]).alias("at"))
    spans = F.aggregate(F.slice("turns", F.col("skip") + 1, F.size("turns")),
                        F.struct(F.lit(-1 << 60).cast("long").alias("base"), F.array().cast("array<int>").alias("at")),
                        cut, lambda acc: acc["at"])
    # A conversation of a system turn alone is one window of that turn.
    conv = conv.withColumn("at", spans).withColumn(
        "at", F.when(F.size("at") > 0, F.col("at")).otherwise(F.array(F.size("turns") + 1)))
    before = lambda p: F.filter(F.slice("turns", F.greatest(p - history_turns, F.col("skip") + 1),
                                        F.least(F.lit(history_turns), p - 1 - F.col("skip"))),
                                lambda t: F.get("turns", p - 2)["upto"] - t["upto"] + t["tokens"] <= history_tokens)
    window = F.transform("at", lambda p, i: F.struct(
        i.alias("window"), F.when(i > 0, F.concat(F.col("lead"), before(p))).otherwise(F.slice("turns", 1, 0)).alias("old"),
        F.concat(F.when(i == 0, F.col("lead")).otherwise(F.slice("turns", 1, 0)),
                 F.slice("turns", p, F.coalesce(F.get("at", i + 1), F.size("turns") + 1) - p)).alias("new")))
    nths = lambda c, old: F.transform(F.col(f"w.{c}.nth"), lambda n: F.struct(F.lit(not old).alias("fresh"), n.alias("nth")))
    places = (conv.select("id", F.explode(window).alias("w"))
              .select("id", "w.window", F.explode(F.concat(nths("old", True), nths("new", False))).alias("at")).select("id", "window", "at.*"))
    texts = told.select(F.col("id").alias("of"), F.col("nth").alias("nr"), "tokens", "head", "body", "target")
    made = (places.join(texts, F.col("id").eqNullSafe(F.col("of")) & (F.col("nth") == F.col("nr")))
            .groupBy("id", "window").agg(F.array_sort(F.collect_list(F.struct(
                "fresh", "nth", "tokens", "head", "body", "target"))).alias("all")))
    repeated = F.size(F.filter("all", lambda t: ~t["fresh"]))
    written = F.array_join(F.transform("all", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "")
    fixed = len(END) + 1
    marked = F.aggregate(
        F.transform("all", lambda t: F.struct(F.length(t["head"]).alias("h"), F.length(t["body"]).alias("b"),
                                                 (t["target"] & t["fresh"]).alias("learn"))),
        F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["pos"] + t["h"] + t["b"] + fixed).alias("pos"),
            F.when(t["learn"], F.concat(acc["spans"], F.array(F.struct(
                (acc["pos"] + t["h"]).alias("start"), (acc["pos"] + t["h"] + t["b"]).alias("end")))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    total = F.aggregate("all", F.lit(0).cast("long"), lambda s, t: s + t["tokens"])
    return made.select(F.col("id").alias(id_col), "window", repeated.alias("n_repeated"),
                       F.size("all").alias("n_turns"), total.alias("n_tokens"), written.alias("formatted"),
                       marked.alias("loss"))


def read_back(windows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation, from formatted windows alone: number of turns and the
    digest of their roles and texts, length and digest of what the loss mask
    covers, and the length of all windows."""
    # every turn ends with END and a line end; nothing follows the last
    turns = F.slice(F.split("formatted", r"<\|im_end\|>\n", -1), F.col("n_repeated") + 1,
                    F.col("n_turns") - F.col("n_repeated"))
    role = lambda t: unescape_role(F.substring(F.substring_index(t, "\n", 1), len(START) + 1, 1 << 30))
    text = lambda t: unescape(F.substring(t, F.instr(t, "\n") + 1, F.length(t)))
    said = F.array_join(F.transform(turns, lambda t: F.concat(role(t), F.lit("\n"), text(t), F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss", lambda s: unescape(
        F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    per = windows.select(id_col, F.struct("window", (F.col("n_turns") - F.col("n_repeated")).alias("n"), said.alias("said"),
                                          learned.alias("learned"), F.length("formatted").alias("chars")).alias("w"))
    whole = per.groupBy(id_col).agg(F.array_sort(F.collect_list("w")).alias("w"))
    joined = lambda c: F.array_join(F.col("w")[c], "")
    add = lambda c: F.aggregate(F.col("w")[c], F.lit(0).cast("long"), lambda s, x: s + x)
    return whole.select(id_col, add("n").alias("n_turns"), F.sha2(joined("said").cast("binary"), 256).alias("turns_sha256"),
                        F.length(joined("learned")).cast("long").alias("loss_chars"),
                        F.sha2(joined("learned").cast("binary"), 256).alias("loss_sha256"),
                        add("chars").alias("formatted_chars"))


def oracle(control_text: str) -> str:
    """The digests from the turns themselves; only the length of the windows
    needs their spans, which a walk along each conversation cuts."""
    broken = r"regexp_replace({}, '<(\\*)\|', '<\1x|', 'g')"  # as long as escaped
    text_len = f"length({broken.format('text')})"
    role_len = "length({})".format(broken.format("replace(replace(role, '%', '%25'), chr(10), '%0A')"))
    return f"""
WITH RECURSIVE turn0 AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{control_text}' UNION ALL SELECT -1, 1, 'assistant', '{control_text}'),
turn1 AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS nth,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) + {TURN_TOKENS} AS tokens
  FROM turn0),
turn2 AS (
  SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY nth) AS upto,
         first(role) OVER (PARTITION BY conv_id ORDER BY nth) = '{SYSTEM_ROLE}' AS led,
         CASE WHEN led THEN first(tokens) OVER (PARTITION BY conv_id ORDER BY nth) ELSE 0 END AS lead_tokens
  FROM turn1),
size AS (
  SELECT *, {len(START) + len(END) + 2} + {text_len} + {role_len} AS len,
         greatest({BUDGET - HISTORY_TOKENS} - lead_tokens, 1) AS room, CASE WHEN led THEN 1 ELSE 0 END AS skip
  FROM turn2),
walk AS (
  SELECT conv_id, nth, upto - tokens AS base, true AS opens FROM size WHERE nth = skip + 1
  UNION ALL
  SELECT t.conv_id, t.nth, CASE WHEN t.upto - w.base > t.room THEN t.upto - t.tokens ELSE w.base END,
         t.upto - w.base > t.room
  FROM walk w JOIN size t ON t.conv_id = w.conv_id AND t.nth = w.nth + 1),
opened AS (SELECT w.conv_id, w.nth, s.skip FROM walk w JOIN size s USING (conv_id, nth) WHERE opens AND w.nth > s.skip + 1),
again AS (
  SELECT o.conv_id, sum(s.len) AS chars
  FROM opened o JOIN size l ON l.conv_id = o.conv_id AND l.nth = o.nth - 1
  JOIN size s ON s.conv_id = o.conv_id AND (
    (s.nth = 1 AND o.skip = 1) OR
    (s.nth BETWEEN greatest(o.nth - {HISTORY_TURNS}, o.skip + 1) AND o.nth - 1
     AND l.upto - s.upto + s.tokens <= {HISTORY_TOKENS}))
  GROUP BY o.conv_id),
said AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY nth) FILTER (WHERE role = '{TARGET_ROLE}'), '') AS learned, sum(len) AS chars
  FROM size GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       (said.chars + coalesce(again.chars, 0))::BIGINT AS formatted_chars
FROM said LEFT JOIN again USING (conv_id)
"""
