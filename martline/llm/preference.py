"""Preference pairs as one prompt and two masked completions (operator 4).

Of a chosen and a rejected conversation the longest common prefix of turns is rendered once as the prompt; what follows is
rendered as the two completions. A mask says which characters of a completion are trained on: the text and the end mark
of the assistant's turns, not the headers and not what others say.

The prefix is found without bringing conversations together: turns of both sides are numbered, counted per number and
compared there, and the first number that differs is a minimum that combines before its shuffle. Each conversation is
then put together once, which is the one thing that needs its turns in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.llm import frames

# Fixed values of the chat format.
HEADER, CLOSE, TRAINED = ("<|", "|>\n"), "<|end|>\n", "assistant"


def _numbered(turns: DataFrame) -> DataFrame:
    """``at``: place of each turn in its conversation, equal turn numbers by role and text."""
    by = Window.partitionBy("pair", "side").orderBy("turn", "role", "text")
    return turns.withColumn("at", F.row_number().over(by))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(HEADER[0]), t["role"], F.lit(HEADER[1]), t["text"], F.lit(CLOSE))), "")


def _mask(turns: Column) -> Column:
    """``start, length`` in characters of what is trained on in the rendered turns."""
    head = len("".join(HEADER))

    def step(seen: Column, t: Column) -> Column:
        before = head + F.length(t["role"])
        body = F.length(t["text"]) + len(CLOSE)
        span = F.struct((seen["at"] + before).cast("long").alias("start"), body.cast("long").alias("length"))
        return F.struct((seen["at"] + before + body).cast("long").alias("at"), F.when(t["role"] == TRAINED, F.concat(seen["spans"], F.array(span))).otherwise(seen["spans"]).alias("spans"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    return F.aggregate(turns, start, step, lambda s: s["spans"])


def format_pairs(turns: DataFrame, pair: Column, side: Column, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row for each pair: ``pair_id, chosen_id, rejected_id, prefix_turns, prompt, chosen, rejected, chosen_mask, rejected_mask``.

    ``pair`` names the pair of a row of ``turns``, ``side`` is 0 in the chosen conversation and 1 in the rejected one. Turns
    follow their numbers; equal numbers, as in repeated rows, follow role and text, and all count. Rows with a null
    conversation, turn, pair or side belong to no pair; a null role or text is empty. A conversation without its
    counterpart is no pair. Equal conversations are all prompt, with empty completions.
    """
    own = turns.select(
        pair.cast("long").alias("pair"), side.cast("int").alias("side"), F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    ).filter("pair IS NOT NULL AND side IN (0, 1) AND conv IS NOT NULL AND turn IS NOT NULL")
    placed = _numbered(own)
    # Two rows of a place that agree are one common turn; a place that is missing on one side ends the prefix too.
    met = placed.groupBy("pair", "at").agg(F.count("*").alias("n"), F.min("role").alias("r0"), F.max("role").alias("r1"), F.min("text").alias("t0"), F.max("text").alias("t1"))
    same = (F.col("n") == 2) & (F.col("r0") == F.col("r1")) & (F.col("t0") == F.col("t1"))
    prefix = met.groupBy("pair").agg((F.coalesce(F.min(F.when(~same, F.col("at"))), F.max("at") + 1) - 1).cast("long").alias("prefix_turns"))
    told = placed.groupBy("pair", "side").agg(F.min("conv").alias("conv"), F.array_sort(F.collect_list(F.struct("at", "role", "text"))).alias("turns"))
    both = told.groupBy("pair").agg(*[F.max(F.when(F.col("side") == k, F.struct("conv", "turns"))).alias(f"s{k}") for k in (0, 1)]).filter("s0 IS NOT NULL AND s1 IS NOT NULL")
    out = both.join(prefix, "pair")
    n = F.col("prefix_turns").cast("int")
    rest = [F.slice(F.col(f"s{k}.turns"), n + 1, F.size(F.col(f"s{k}.turns"))) for k in (0, 1)]
    return out.select(
        F.col("pair").alias("pair_id"), F.col("s0.conv").alias("chosen_id"), F.col("s1.conv").alias("rejected_id"), "prefix_turns",
        _rendered(F.slice(F.col("s0.turns"), 1, n)).alias("prompt"), _rendered(rest[0]).alias("chosen"), _rendered(rest[1]).alias("rejected"),
        _mask(rest[0]).alias("chosen_mask"), _mask(rest[1]).alias("rejected_mask"),
    )


def op4_preference_format(spark, sf_dir: str) -> DataFrame:
    """Operator 4 over ``conversations``: of ids 2k and 2k + 1 the first is the chosen one. The masks as ``start+length`` texts."""
    turns = frames.table(spark, sf_dir, "conversations")
    done = format_pairs(turns, F.floor(F.col("conv_id") / 2), F.pmod(F.col("conv_id"), F.lit(2)))
    plain = [F.array_join(F.transform(c, lambda s: F.concat_ws("+", s["start"].cast("string"), s["length"].cast("string"))), " ").alias(c) for c in ("chosen_mask", "rejected_mask")]
    return done.select(*[c for c in done.columns if not c.endswith("_mask")], *plain)


SQL = """
WITH t AS (
  SELECT conv_id // 2 AS pair, conv_id % 2 AS side, conv_id, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL)
), m AS (
  SELECT pair, k, count(*) = 2 AND count(DISTINCT role) = 1 AND count(DISTINCT text) = 1 AS same FROM t GROUP BY pair, k
), p AS (
  SELECT pair, coalesce(min(k) FILTER (WHERE NOT same), max(k) + 1) - 1 AS n FROM m GROUP BY pair
), r AS (
  SELECT t.pair, side, conv_id, k, n, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS s, role, text FROM t JOIN p USING (pair)
), o AS (
  SELECT *, CASE WHEN k > n THEN coalesce(sum(CASE WHEN k > n THEN length(s) END) OVER (PARTITION BY conv_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS start FROM r
), c AS (
  SELECT pair, side, any_value(conv_id) AS conv_id, any_value(n) AS n,
    coalesce(string_agg(s, '' ORDER BY k) FILTER (WHERE k <= n), '') AS prompt,
    coalesce(string_agg(s, '' ORDER BY k) FILTER (WHERE k > n), '') AS done,
    coalesce(string_agg(CAST(start + 5 + length(role) AS BIGINT) || '+' || (length(text) + 8), ' ' ORDER BY k) FILTER (WHERE k > n AND role = 'assistant'), '') AS mask
  FROM o GROUP BY pair, side
)
SELECT a.pair AS pair_id, a.conv_id AS chosen_id, b.conv_id AS rejected_id, CAST(a.n AS BIGINT) AS prefix_turns, a.prompt,
  a.done AS chosen, b.done AS rejected, a.mask AS chosen_mask, b.mask AS rejected_mask
FROM c a JOIN c b ON a.pair = b.pair AND a.side = 0 AND b.side = 1
"""
