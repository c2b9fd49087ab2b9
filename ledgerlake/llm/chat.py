"""Chat formatting: one rendering of each dialogue per participant.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and every other speaker as a named user; the loss
mask covers what the assistant says, end marker included, and nothing else.
Speakers in ``context`` (such as system) are rendered as themselves, are no
participants and are never learned.

The result is one row per (conversation, perspective, turn): ``segment``; its
``start``, the code point of the perspective's rendering at which it begins;
and ``mask_start`` / ``mask_end``, the code points of the segment to learn (end
exclusive; both null where nothing is learned).  A rendering is its segments in
the order (turn, speaker, text), nulls first, one after the other, so
``start + mask_start`` is a place in the whole dialogue.  Segments are not
gathered into one string, so a conversation of any length - a third of all
rows, say - never meets in one task: turns are written in ranges of their
order, each range adds up the lengths of its own segments, and what the earlier
ranges of a conversation hold is added per (conversation, range, participant)
from counts.  The result's size is what is asked for: turns times participants.

Defined cases: turns of a null conversation form one conversation, a null or
empty text is an empty turn.  Repeated rows are repeated turns; ties in
``turn`` follow the order above.  Different roles stay different speakers:
names keep letters, digits and ``_.-``, any other character becomes ``%`` and
the hexadecimal digits of its UTF-8 bytes, and a null role is ``%null``, which
no role can become.  ``<|`` in a text becomes ``< |``, so no text can forge a
marker.  Other columns are not needed and do not clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

START, END = "<|im_start|>", "<|im_end|>"
OTHER, OWN = "user", "assistant"
NAME = " name="


def speaker_of(role: Column) -> Column:
    """A name for each role, different for different roles."""
    escaped = F.transform(F.split(role.cast("string"), ""), lambda c: F.when(c.rlike(r"^[\p{L}\p{N}_.-]?$"), c).otherwise(
        F.concat(F.lit("%"), F.hex(F.encode(c, "UTF-8")))))
    return F.coalesce(F.array_join(escaped, ""), F.lit("%null"))


def _turns_in_order(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
                    context: tuple[str, ...]) -> DataFrame:
    """The turns in a written table of sorted ranges: ``part`` numbers the
    ranges and ``seq`` the turns in the order of their renderings; ``key`` is
    the conversation, never null."""
    conv, role = F.col(f"`{conv_col}`"), F.col(f"`{role_col}`")
    said = turns.select(F.coalesce(F.concat(F.lit("c"), conv.cast("string")), F.lit("")).alias("key"),
                        conv.alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), speaker_of(role).alias("speaker"),
                        F.coalesce(role.cast("string").isin(*context), F.lit(False)).alias("is_context"),
                        F.replace(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.lit("<|"),
                                  F.lit("< |")).alias("text"),
                        F.monotonically_increasing_id().alias("row"))  # parts equal turns among ranges
    order = ["key", "turn", "speaker", "text", "row"]
    return written(said.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
                   .withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id()), "turns")


def _views(said: DataFrame) -> DataFrame:
    """(key, part, perspective, before): the participants at each range of
    their conversation and the code points of the earlier ranges' segments."""
    as_other = (F.length("text") + F.length("speaker") + F.when(F.col("is_context"), 0).otherwise(len(OTHER + NAME))
                + len(START + "\n" + END + "\n"))
    totals = written(said.groupBy("key", "part", "speaker", "is_context").agg(
        F.sum(as_other).alias("chars"), F.count(F.lit(1)).alias("spoken")), "turn-totals")
    ranges = totals.groupBy("key", "part").agg(F.sum("chars").alias("chars"))
    spoke = totals.where(~F.col("is_context")).select("key", "part", F.col("speaker").alias("perspective"), "spoken")
    grid = ranges.join(spoke.select("key", "perspective").distinct(), "key").join(
        spoke, ["key", "part", "perspective"], "left")
    shorter = len(OTHER + NAME) + F.length("perspective") - len(OWN)  # by so much, where the speaker is the assistant
    earlier = Window.partitionBy("key", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    chars = F.col("chars") - F.coalesce("spoken", F.lit(0)) * shorter
    return grid.select("key", "part", "perspective", F.coalesce(F.sum(chars).over(earlier), F.lit(0)).alias("before"))


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", context: tuple[str, ...] = ("system",)) -> DataFrame:
    """(conv_id, perspective, turn, speaker, role, segment, start, mask_start,
    mask_end), see the module docstring."""
    said = _turns_in_order(turns, conv_col, turn_col, role_col, text_col, context)
    # merged on (key, part), which the running sums below need too: texts are
    # multiplied by the participants after their shuffle, not before it
    seen = said.join(_views(said).hint("merge"), ["key", "part"])
    own = ~F.col("is_context") & (F.col("speaker") == F.col("perspective"))
    role = F.when(own, OWN).when(F.col("is_context"), F.col("speaker")).otherwise(OTHER)
    named = F.when(own | F.col("is_context"), "").otherwise(F.concat(F.lit(NAME), "speaker"))
    head = F.concat(F.lit(START), role, named, F.lit("\n"))
    learned = F.length(head)
    seen = seen.select("*", role.alias("role"), F.concat(head, F.col("text"), F.lit(END + "\n")).alias("segment"),
                       F.when(own, learned).cast("long").alias("mask_start"),
                       F.when(own, learned + F.length("text") + len(END)).cast("long").alias("mask_end"))
    earlier = Window.partitionBy("key", "part", "perspective").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum(F.length("segment")).over(earlier), F.lit(0))
    return seen.select("conv_id", "perspective", "turn", "speaker", "role", "segment", start.alias("start"),
                       "mask_start", "mask_end")


ORACLE_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(array_to_string(list_transform(string_split(role, ''), lambda c:
           CASE WHEN regexp_full_match(c, '[\p{L}\p{N}_.-]?') THEN c ELSE '%' || hex(encode(c)) END), ''), '%null') AS speaker,
         coalesce(role = 'system', false) AS is_context, replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations),
part AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE NOT is_context),
views AS (
  SELECT s.conv_id, p.perspective, s.turn, s.speaker, s.text,
         CASE WHEN s.is_context THEN 'system' WHEN s.speaker = p.perspective THEN 'assistant' ELSE 'user' END AS role
  FROM said s JOIN part p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
headed AS (
  SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END || chr(10) AS head
  FROM views)
SELECT conv_id, perspective, turn, speaker, role, head || text || '<|im_end|>' || chr(10) AS segment,
       CAST(coalesce(sum(length(head) + length(text) + 11) OVER (
         PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "start",
       CASE WHEN role = 'assistant' THEN CAST(length(head) AS BIGINT) END AS mask_start,
       CASE WHEN role = 'assistant' THEN CAST(length(head) + length(text) + 10 AS BIGINT) END AS mask_end
FROM headed
"""
