"""Chat formatting: multi-party perspective rotation, DataFrame functions only.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant, all others as
named users and system turns as they are.  The mask marks, in characters of the rendering, what the chosen speaker says with the
turn's end mark.  A conversation is rendered in segments of ``segment`` turn numbers; the segments of one perspective, joined in
order, are its whole rendering, so a conversation of any length is spread over many tasks.

Defined cases: a null or empty role is the participant ``unknown``; a null text is empty; rows with a null conversation id
form one conversation; a null turn comes first, in segment -1; turns that share a number are ordered by speaker, then text;
repeated rows are rendered each; a conversation of system turns alone has no participant and gives no rows; an empty
table gives no rows; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import read

SEGMENT = 256
START, END = "<|im_start|>", "<|im_end|>\n"


def heading(speaker: Column, perspective: Column) -> Column:
    return (
        F.when(speaker == perspective, F.lit(f"{START}assistant\n"))
        .when(speaker == "system", F.lit(f"{START}system\n"))
        .otherwise(F.concat(F.lit(f"{START}user name="), speaker, F.lit("\n")))
    )


def rotate(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``(conv_id, perspective, segment, n_turns, n_own_turns, rendered, mask)`` of ``(conv_id, turn, role, text)``.

    ``mask`` lists ``begin-end;`` character ranges (end excluded) of the segment's rendering that are trained on.
    """
    speaker = F.coalesce(F.nullif("role", F.lit("")), F.lit("unknown"))
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), speaker.alias("speaker"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.expr(f"cast(floor(turn / {segment}) as long)"), F.lit(-1)).alias("segment"),
    )
    told = rows.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "speaker", "text"))).alias("said"))
    people = rows.where("speaker <> 'system'").select(F.col("conv_id").alias("__conv"), F.col("speaker").alias("perspective")).distinct()
    seen = told.join(people, told["conv_id"].eqNullSafe(people["__conv"]))
    who = F.col("perspective")

    def grow(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(heading(turn["speaker"], who))
        end = begin + F.length(turn["text"]) + (len(END) - 1)
        own = turn["speaker"] == who
        span = F.when(own, F.concat(begin.cast("string"), F.lit("-"), end.cast("string"), F.lit(";"))).otherwise(F.lit(""))
        return F.struct((end + 1).alias("at"), F.concat(state["mask"], span).alias("mask"))

    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("mask"))
    return seen.select(
        "conv_id", "perspective", "segment", F.size("said").cast("long").alias("n_turns"),
        F.size(F.filter("said", lambda t: t["speaker"] == who)).cast("long").alias("n_own_turns"),
        F.array_join(F.transform("said", lambda t: F.concat(heading(t["speaker"], who), t["text"], F.lit(END))), "").alias("rendered"),
        F.aggregate("said", empty, grow)["mask"].alias("mask"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(read(spark, sf_dir, "conversations"))


SQL = f"""
with b as (
  select conv_id, turn, coalesce(nullif(role, ''), 'unknown') as sp, coalesce(text, '') as t, coalesce(cast(floor(turn / {SEGMENT}) as bigint), -1) as segment
  from conversations
),
p as (select distinct conv_id, sp as perspective from b where sp <> 'system'),
h as (
  select b.*, perspective, sp = perspective as own,
         '{START}' || case when sp = perspective then 'assistant' when sp = 'system' then 'system' else 'user name=' || sp end || chr(10) as head
  from b join p on b.conv_id is not distinct from p.conv_id
),
g as (
  select *, head || t || '<|im_end|>' || chr(10) as piece,
         coalesce(sum(length(head) + length(t) + {len(END)}) over (partition by conv_id, perspective, segment order by turn nulls first, sp, t rows between unbounded preceding and 1 preceding), 0) + length(head) as begin
  from h
)
select conv_id, perspective, segment, count(*) as n_turns, count(*) filter (own) as n_own_turns,
       string_agg(piece, '' order by turn nulls first, sp, t) as rendered,
       coalesce(string_agg(begin || '-' || (begin + length(t) + {len(END) - 1}) || ';', '' order by turn nulls first, sp, t) filter (own), '') as mask
from g group by conv_id, perspective, segment
"""

QUERIES = {"op5_chat_format": query}
ORACLE = {"op5_chat_format": SQL}
