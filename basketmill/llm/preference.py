"""Preference formatting: one prompt, two masked completions.

For a pair of conversations the longest common turn prefix is rendered once as the prompt; what follows in
each becomes the chosen and the rejected completion. Results are turn by turn, so that no conversation has
to fit into one row: the text of a part is its ``rendered`` values in the order of ``turn``. Only answers in
completions are trained on; ``mask_start`` and ``mask_end`` mark the trained characters of a turn.

Everything is DataFrame code. Turns are compared by counts per turn, so a long conversation is spread
over many tasks; the text itself crosses the network once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm.staging import written
from basketmill.operators.ordering import number_rows

ANSWERS = "assistant"
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
_FIRST = -(1 << 63)


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """Neighbouring conversations as pairs: the even conv_id is chosen, the odd one after it rejected."""
    pair = F.floor(F.col("conv_id") / 2).cast("bigint")
    side = F.pmod(F.col("conv_id"), F.lit(2)).cast("int")
    return turns.where("conv_id IS NOT NULL").select(pair.alias("pair_id"), side.alias("side"), "turn", "role", "text")


def swapped_answers(turns: DataFrame) -> DataFrame:
    """Every conversation as chosen, and as rejected with its last answer replaced by another conversation's.

    The last answer is what the assistant says in the highest turn that has an answer (a null turn is the lowest; of several
    answers in it all are replaced); it is replaced by that of the next conversation with an answer in the order of conv_id,
    after the last comes the first. Both sides share all turns before it. A conversation without an answer, or the only
    one with one, is equal on both sides. conv_id may be of any type that can be sorted; turns without one belong to no
    conversation and are left out.
    """
    plain = turns.where("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text")
    place = F.coalesce(F.col("turn").cast("bigint"), F.lit(_FIRST))
    is_answer = F.coalesce(F.col("role") == ANSWERS, F.lit(False))
    last = F.max(F.struct(place.alias("place"), F.col("text").alias("text")))
    answers = written(plain.where(is_answer).groupBy("conv_id").agg(last.alias("last")), "answers")
    numbered = number_rows(answers.select("conv_id"), ["conv_id"], "number").join(answers, "conv_id")
    n = max(answers.count(), 1)
    others = numbered.select(F.col("number").alias("next"), F.col("last.text").alias("other"))
    swaps = numbered.withColumn("next", F.col("number") % n + 1).join(others, "next")
    swaps = written(swaps.select("conv_id", F.col("last.place").alias("last_place"), "other"), "swaps")
    swapped = F.when(is_answer & (place == F.col("last_place")), F.col("other")).otherwise(F.col("text"))
    rejected = plain.join(swaps, "conv_id", "left").withColumn("text", swapped)
    sides = [df.select(F.col("conv_id").alias("pair_id"), F.lit(i).alias("side"), "turn", "role", "text") for i, df in enumerate((plain, rejected))]
    return sides[0].unionByName(sides[1])


def _rendered(role: Column, text: Column) -> tuple[Column, Column]:
    head = F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit(CLOSE))
    return head, F.concat(head, F.coalesce(text, F.lit("")), F.lit(END))


def common_prefix(sided: DataFrame) -> DataFrame:
    """(pair_id, differs): the first turn in which the sides of a pair differ, null if in none; pairs of two sides only."""
    place = F.coalesce(F.col("turn").cast("bigint"), F.lit(_FIRST)).alias("place")
    digest = F.unhex(F.md5("text")).alias("digest")
    counts = sided.select("pair_id", "side", place, "role", digest).groupBy("pair_id", "place", "role", "digest")
    counts = counts.agg(F.sum(F.when(F.col("side") == 0, 1).otherwise(0)).alias("n0"), F.sum(F.when(F.col("side") == 1, 1).otherwise(0)).alias("n1"))
    pairs = counts.groupBy("pair_id").agg(
        F.min(F.when(F.col("n0") != F.col("n1"), F.col("place"))).alias("differs"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")
    )
    return pairs.where("n0 > 0 AND n1 > 0").select("pair_id", "differs")


def preference_segments(sided: DataFrame) -> DataFrame:
    """Per turn: pair_id, part (prompt, chosen or rejected), turn, role, rendered, mask_start, mask_end.

    ``sided`` has pair_id, side (0 chosen, 1 rejected), turn, role and text. Turns are ordered by number, a null
    number first; a turn is common if both sides hold the same roles and texts under it, as often as each
    other, and so are all before it. Equal sides have a prompt and no completions. A side without its
    partner gives no rows. A null role or text is rendered as empty and differs from an empty one.
    Repeated turns are rendered as often as they occur.
    """
    prefix = written(common_prefix(sided), "prefixes")
    place = F.coalesce(F.col("turn").cast("bigint"), F.lit(_FIRST))
    common = F.col("differs").isNull() | (place < F.col("differs"))
    part = F.when(common, F.lit("prompt")).when(F.col("side") == 0, F.lit("chosen")).otherwise(F.lit("rejected"))
    head, rendered = _rendered(F.col("role"), F.col("text"))
    trained = ~common & F.coalesce(F.col("role") == ANSWERS, F.lit(False))
    joined = sided.select("pair_id", "side", "turn", "role", "text").join(prefix, "pair_id").where(~common | (F.col("side") == 0))
    return joined.select(
        "pair_id",
        part.alias("part"),
        "turn",
        "role",
        rendered.alias("rendered"),
        F.when(trained, F.length(head)).otherwise(0).alias("mask_start"),
        F.when(trained, F.length(rendered)).otherwise(0).alias("mask_end"),
    )


# The same over conversations and their swapped answers, as SQL.
ORACLE = """
WITH last AS (SELECT conv_id, max(turn) AS turn, max(text) AS text
              FROM (SELECT * FROM conversations WHERE role = 'assistant' QUALIFY turn = max(turn) OVER (PARTITION BY conv_id)) GROUP BY conv_id),
numbered AS (SELECT *, row_number() OVER (ORDER BY conv_id) AS number, count(*) OVER () AS n FROM last),
swaps AS (SELECT a.conv_id, a.turn AS last_turn, b.text AS other FROM numbered a JOIN numbered b ON b.number = a.number % a.n + 1),
t AS (SELECT conv_id AS pair_id, 0 AS side, turn, role, text FROM conversations
      UNION ALL
      SELECT conv_id, 1, turn, role, CASE WHEN role = 'assistant' AND turn = last_turn THEN other ELSE text END
      FROM conversations LEFT JOIN swaps USING (conv_id)),
c AS (SELECT pair_id, turn, role, text, count(*) FILTER (side = 0) AS n0, count(*) FILTER (side = 1) AS n1
      FROM t GROUP BY ALL),
p AS (SELECT pair_id, min(turn) FILTER (n0 <> n1) AS differs FROM c GROUP BY pair_id HAVING sum(n0) > 0 AND sum(n1) > 0),
j AS (SELECT t.*, differs IS NULL OR turn < differs AS common FROM t JOIN p USING (pair_id)),
r AS (SELECT *, '<|' || coalesce(role, '') || '|>' || chr(10) AS head FROM j WHERE NOT common OR side = 0)
SELECT pair_id, CASE WHEN common THEN 'prompt' WHEN side = 0 THEN 'chosen' ELSE 'rejected' END AS part, turn, role,
       head || coalesce(text, '') || '<|end|>' || chr(10) AS rendered,
       CASE WHEN NOT common AND role = 'assistant' THEN length(head) ELSE 0 END::INTEGER AS mask_start,
       CASE WHEN NOT common AND role = 'assistant' THEN length(head) + length(coalesce(text, '')) + 8 ELSE 0 END::INTEGER AS mask_end
FROM r
"""
