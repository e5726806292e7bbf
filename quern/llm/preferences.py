"""Preference formatting: one prompt from what two conversations share, and two masked completions.

The longest common prefix of turns of a chosen and a rejected conversation is rendered once as the prompt;
what follows in each is rendered as a completion, with the ranges of characters that count for training:
the text and end mark of assistant turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import OWN, with_results

# The marks around a turn.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNED = "assistant"
#: Conversations that lend each other replies, on average; which do, a hash of their ids decides.
BLOCK = 64


def header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit(CLOSE))


def body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(END))


def render(turns: Column) -> Column:
    """All turns as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(header(t), body(t))), "")


def learned(turns: Column) -> Column:
    """Ranges (start, end) of characters of the rendered turns that belong to assistant turns."""
    kind = "struct<at: int, spans: array<struct<start: int, end: int>>>"

    def add(acc: Column, turn: Column) -> Column:
        start = acc["at"] + F.length(header(turn))
        end = start + F.length(body(turn))
        mine = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == LEARNED, F.concat(acc["spans"], mine)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    none = F.array().cast("array<struct<start: int, end: int>>")
    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("spans")).cast(kind), add)["spans"]


def shared_turns(a: Column, b: Column) -> Column:
    """How many leading turns agree in role and text; null agrees with null."""
    shorter = F.least(F.size(a), F.size(b))
    places = F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>"))

    def differs(i: Column) -> Column:
        x, y = F.get(a, i), F.get(b, i)
        return ~(x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))

    return F.coalesce(F.get(F.filter(places, differs), F.lit(0)), shorter)


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Replaces two columns of turns (array of role and text) by what training reads.

    Adds prompt_turns, prompt, chosen_text, rejected_text, chosen_mask and rejected_mask (arrays of start and
    end); drops the two columns. A null conversation has no turns. Equal conversations leave both
    completions empty. Null roles and texts are rendered as empty. Every row stays; input columns called
    like the results give way. An empty table gives an empty one.
    """
    none = F.array().cast("array<struct<role: string, text: string>>")
    a, b = f"{OWN}chosen", f"{OWN}rejected"
    turns = pairs.withColumns({a: F.coalesce(F.col(f"`{chosen}`"), none), b: F.coalesce(F.col(f"`{rejected}`"), none)})
    counted = turns.drop(chosen, rejected).withColumn(f"{OWN}n", shared_turns(F.col(a), F.col(b)))

    def rest(name: str) -> Column:
        return F.slice(F.col(name), F.col(f"{OWN}n") + 1, F.greatest(F.size(name), F.lit(1)))

    cut = counted.withColumns({f"{OWN}prompt": F.slice(F.col(a), F.lit(1), F.col(f"{OWN}n")), f"{OWN}a": rest(a), f"{OWN}b": rest(b)})
    out = with_results(
        cut,
        {
            "prompt_turns": F.col(f"{OWN}n"),
            "prompt": render(F.col(f"{OWN}prompt")),
            "chosen_text": render(F.col(f"{OWN}a")),
            "rejected_text": render(F.col(f"{OWN}b")),
            "chosen_mask": learned(F.col(f"{OWN}a")),
            "rejected_mask": learned(F.col(f"{OWN}b")),
        },
    )
    return out.drop(a, b, *[f"{OWN}{x}" for x in ("n", "prompt", "a", "b")])


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order; turns without a conversation are left out.

    Turns of one number are ordered by role, then text, null first; repeated turns stay. Other columns, whatever they are called,
    are left out. An empty table gives an empty one.
    """
    known = turns.where("conv_id is not null").select("conv_id", F.struct(F.col("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).alias("t"))
    rows = known.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return rows.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def with_borrowed_reply(rows: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected): rejected has the last assistant reply of the next conversation in its place.

    Conversations with a reply are dealt into blocks of some BLOCK by a hash of their id, however far apart ids are. The next is
    that with the next greater id in the block, after the last the first. A conversation without a reply, or the only one with a
    reply, is its own counterpart. Other columns are left out. An empty table gives an empty one.
    """
    places = F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == LEARNED, i)), lambda i: i.isNotNull())
    last, lent_ = f"{OWN}last", f"{OWN}lent"
    marked = rows.select("conv_id", "turns", F.array_max(places).alias(last))
    blocks = marked.where(F.col(last).isNotNull()).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("long"))).scalar()
    hashed = F.conv(F.substring(F.md5(F.col("conv_id").cast("string")), 1, 8), 16, 10).cast("long")
    block = Window.partitionBy(hashed % blocks, F.col(last).isNull()).orderBy("conv_id")
    reply = F.get("turns", F.col(last))["text"]
    first = F.first(F.struct(reply.alias("r"))).over(block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    lent = F.coalesce(F.lead(F.struct(reply.alias("r"))).over(block), first)["r"]
    rejected = F.transform("turns", lambda t, i: F.when(i == F.col(last), F.struct(t["role"].alias("role"), F.col(lent_).alias("text"))).otherwise(t))
    return marked.withColumn(lent_, lent).select("conv_id", F.col("turns").alias("chosen"), rejected.alias("rejected"))


def listed(mask: str) -> Column:
    return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(formatted: DataFrame) -> DataFrame:
    return formatted.select("conv_id", F.col("prompt_turns").cast("long").alias("prompt_turns"), "prompt", "chosen_text", "rejected_text", listed("chosen_mask").alias("chosen_mask"), listed("rejected_mask").alias("rejected_mask"))


ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
lasts AS (SELECT conv_id, max(i) FILTER (WHERE role = '{LEARNED}') AS last FROM t GROUP BY conv_id),
replies AS (SELECT l.conv_id, l.last, t.text AS reply FROM lasts l JOIN t ON t.conv_id = l.conv_id AND t.i = l.last),
lent AS (
  SELECT conv_id, last,
    CASE WHEN lead(conv_id) OVER w IS NULL THEN first_value(reply) OVER w ELSE lead(reply) OVER w END AS lent
  FROM replies WINDOW w AS (PARTITION BY ('0x' || substr(md5(conv_id::VARCHAR), 1, 8))::BIGINT % (SELECT greatest(1, ceil(count(*) / {BLOCK}.0))::BIGINT FROM replies) ORDER BY conv_id)),
both_ AS (SELECT t.conv_id, t.i, t.role, t.text AS chosen, CASE WHEN t.i = r.last THEN r.lent ELSE t.text END AS rejected FROM t LEFT JOIN lent r USING (conv_id)),
shared AS (
  SELECT conv_id, coalesce(min(i) FILTER (WHERE chosen IS DISTINCT FROM rejected) - 1, count(*)) AS n FROM both_ GROUP BY conv_id),
made AS (
  SELECT b.conv_id, b.i, s.n, b.role, '{OPEN}' || coalesce(b.role, '') || '|>' || chr(10) AS head,
    coalesce(b.chosen, '') || '<|end|>' || chr(10) AS c, coalesce(b.rejected, '') || '<|end|>' || chr(10) AS r
  FROM both_ b JOIN shared s USING (conv_id)),
placed AS (
  SELECT *, sum(CASE WHEN i > n THEN length(head) + length(c) ELSE 0 END) OVER w AS c_end, sum(CASE WHEN i > n THEN length(head) + length(r) ELSE 0 END) OVER w AS r_end
  FROM made WINDOW w AS (PARTITION BY conv_id ORDER BY i))
SELECT conv_id, any_value(n)::BIGINT AS prompt_turns,
  coalesce(string_agg(head || c, '' ORDER BY i) FILTER (WHERE i <= n), '') AS prompt,
  coalesce(string_agg(head || c, '' ORDER BY i) FILTER (WHERE i > n), '') AS chosen_text,
  coalesce(string_agg(head || r, '' ORDER BY i) FILTER (WHERE i > n), '') AS rejected_text,
  coalesce(string_agg((c_end - length(c))::BIGINT || ':' || c_end::BIGINT, ',' ORDER BY i) FILTER (WHERE i > n AND role = '{LEARNED}'), '') AS chosen_mask,
  coalesce(string_agg((r_end - length(r))::BIGINT || ':' || r_end::BIGINT, ',' ORDER BY i) FILTER (WHERE i > n AND role = '{LEARNED}'), '') AS rejected_mask
FROM placed GROUP BY conv_id"""
