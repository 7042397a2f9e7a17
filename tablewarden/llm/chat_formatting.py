"""Chat formatting: the same dialogue rendered once from the perspective of every participant.

For each participant the own turns are the assistant's and are trained on; everybody else is a
named user. The result is one row per turn and perspective with its place in the rendered dialogue,
so a dialogue of any length is never held in one row; ``whole_dialogues`` puts short ones together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import prepare, table
from tablewarden.operators.scale import positions

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM, ASSISTANT, USER = "system", "assistant", "user"
UNNAMED = "unnamed"


def safe_name(speaker: Column) -> Column:
    """A name in one line without control tokens; different speakers keep different names."""
    out = speaker
    for bare, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("<|", "<\\|")):
        out = F.replace(out, F.lit(bare), F.lit(escaped))
    out = F.when(out.rlike(f"^{UNNAMED}~*$"), F.concat(out, F.lit("~"))).otherwise(out)
    return F.coalesce(out, F.lit(UNNAMED))


def rotate(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text"
) -> DataFrame:
    """One row per turn and perspective: conv_id, perspective, position, role, name, content, rendered,
    start, end (code points of ``rendered`` in the dialogue, end exclusive) and target_start,
    target_end (the part that is trained on; null where another speaks).

    The system speaker sets the scene and is no participant: its turns stay system turns. A null
    speaker is a participant named ``unnamed``; one who is really called that gets a ``~`` behind the
    name, and so on, so that no two speakers become one. Names are written with escapes for line ends,
    ``<|`` and the escape itself, so no name can forge a turn either. A null text is empty. Turns are ordered by turn
    number (null first), then speaker, then text; repeated rows stay. Control tokens inside a text
    are broken up by a zero-width space, so no text can forge a turn. Null dialogue ids are one
    dialogue. A dialogue with only system turns has no perspective and no rows.
    """
    prepare(turns.sparkSession)
    safe = F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"<\|(im_start|im_end)\|>", "<​|$1|>")
    base = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        safe_name(F.col(speaker).cast("string")).alias("speaker"),
        safe.alias("content"),
    )
    people = base.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    seen = base.join(people, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    own = F.col("speaker") == F.col("perspective")
    system = F.col("speaker") == SYSTEM
    role = F.when(system, SYSTEM).when(own, ASSISTANT).otherwise(USER)
    name = F.when(~system & ~own, F.col("speaker"))
    head = F.concat(F.lit(OPEN), role, F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit("\n"))
    rows = seen.select(
        "conv_id",
        "perspective",
        "turn",
        "speaker",
        role.alias("role"),
        name.alias("name"),
        "content",
        F.concat(head, F.col("content"), F.lit(CLOSE)).alias("rendered"),
        F.length(head).cast("bigint").alias("head_length"),
    ).withColumn("length", F.length("rendered").cast("bigint"))
    by, order = ["conv_id", "perspective"], [F.col("turn"), F.col("speaker"), F.col("content")]
    rows = positions(rows, by, order, out="end", weight="length", width=None)
    start = F.col("end") - F.col("length")
    first = start + F.col("head_length")
    mine = F.col("role") == ASSISTANT
    return rows.select(
        "conv_id",
        "perspective",
        "turn",
        "role",
        "name",
        "content",
        "rendered",
        start.alias("start"),
        "end",
        # the mask covers the own words and the closing token, which ends a reply
        F.when(mine, first).alias("target_start"),
        F.when(mine, F.col("end")).alias("target_end"),
    )


def whole_dialogues(rotated: DataFrame) -> DataFrame:
    """conv_id, perspective, text and masks of each dialogue in one row, for dialogues that fit in one."""
    parts = F.array_sort(F.collect_list(F.struct("start", "end", "rendered", "target_start", "target_end")))
    packed = rotated.groupBy("conv_id", "perspective").agg(parts.alias("p"))
    mask = F.filter("p", lambda x: x["target_start"].isNotNull())
    return packed.select(
        "conv_id",
        "perspective",
        F.concat_ws("", F.col("p.rendered")).alias("text"),
        F.transform(mask, lambda x: F.struct(x["target_start"].alias("start"), x["target_end"].alias("end"))).alias("masks"),
    )


def op8_perspective_rotation(spark, sf_dir):
    return rotate(table(spark, sf_dir, "conversations"))


OP8_SQL = """
WITH named AS (
  SELECT *, replace(replace(replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'),
    '<|', '<' || chr(92) || '|') AS said FROM conversations
), base AS (
  SELECT conv_id, turn, CASE WHEN said IS NULL THEN 'unnamed' WHEN regexp_matches(said, '^unnamed~*$') THEN said || '~' ELSE said END AS speaker,
    regexp_replace(coalesce(text, ''), '<\\|(im_start|im_end)\\|>', '<' || chr(8203) || '|\\1|>', 'g') AS content
  FROM named
), seen AS (
  SELECT b.*, p.perspective,
    CASE WHEN b.speaker = 'system' THEN 'system' WHEN b.speaker = p.perspective THEN 'assistant' ELSE 'user' END AS role,
    CASE WHEN b.speaker <> 'system' AND b.speaker <> p.perspective THEN b.speaker END AS name
  FROM base b JOIN (SELECT DISTINCT conv_id, speaker AS perspective FROM base WHERE speaker <> 'system') p
    ON b.conv_id IS NOT DISTINCT FROM p.conv_id
), headed AS (
  SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM seen
), placed AS (
  SELECT *, head || content || '<|im_end|>' || chr(10) AS rendered,
    sum(length(head || content || '<|im_end|>' || chr(10))) OVER (PARTITION BY conv_id, perspective
      ORDER BY turn NULLS FIRST, speaker, content ROWS UNBOUNDED PRECEDING)::BIGINT AS stop
  FROM headed
)
SELECT conv_id, perspective, turn, role, name, content, rendered, stop - length(rendered) AS start, stop AS "end",
  CASE WHEN role = 'assistant' THEN stop - length(rendered) + length(head) END AS target_start,
  CASE WHEN role = 'assistant' THEN stop END AS target_end
FROM placed
"""
