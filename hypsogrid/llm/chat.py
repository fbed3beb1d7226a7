"""Multi-party perspective rotation: each participant in turn is the assistant, all others are named users.

For every conversation and participant the dialogue is rendered as one text, with the character spans that
the participant itself says (text and end mark), which are what a model is trained on.

Places are found in two levels: the lengths of runs of RUN turns are summed up first, then the places in each run.

A conversation is one rendering for each participant, whatever its length, as a model needs all that was said
before; so it has to fit a row of Spark, some 2 GB. Spans count characters from its start.

In names and texts `<|` is written `< |` and in names `|>` is written `| >`, so that nothing said looks like a mark.

Edge cases: the role `system` is no participant and stays a system message in every perspective; a
conversation of system messages only gives no rows; NULL role is the participant `unknown`; NULL text is
empty; a NULL turn comes before all others; turns that tie, and repeated rows, are ordered by turn, name and
text and all kept; each row with a NULL conv_id is a conversation of its own, as nothing says that two of them
belong together; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYSTEM = "system"
#: Turns whose places are found one after another; a dialogue's time grows with its turns by this number, not by their square.
RUN = 256
END = "<|end|>\n"


def perspectives(turns: DataFrame) -> DataFrame:
    """conv_id, perspective, n_turns, n_own_turns, text, spans (array of start and end, half-open)."""
    name = F.replace(F.replace(F.coalesce("role", F.lit("unknown")), F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))
    text = F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |"))
    said = turns.select("conv_id", F.struct("turn", name.alias("name"), text.alias("text")).alias("s"))
    lone = said.where("conv_id is null").select("conv_id", F.array("s").alias("said"))
    talks = said.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("s")).alias("said")).unionByName(lone)
    speakers = F.array_distinct(F.filter(F.transform("said", lambda s: s["name"]), lambda n: n != SYSTEM))
    viewed = talks.select("conv_id", "said", F.explode(speakers).alias("perspective"))
    head = lambda s: (
        F.when(s["name"] == SYSTEM, F.lit("<|system|>\n")).when(s["name"] == F.col("perspective"), F.lit("<|assistant|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), s["name"], F.lit("|>\n")))
    )
    laid = viewed.select("conv_id", "perspective", F.transform("said", lambda s: F.struct(
        head(s).alias("head"), F.concat(s["text"], F.lit(END)).alias("body"), (s["name"] == F.col("perspective")).alias("own"))).alias("said"))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans"))

    def place(a, s):
        start = a["at"] + F.length(s["head"])
        end = start + F.length(s["body"])
        spans = F.when(s["own"], F.array_append(a["spans"], F.struct(start.alias("start"), end.alias("end")))).otherwise(a["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    run = lambda k: F.slice("said", k * RUN + 1, F.lit(RUN))
    runs = laid.withColumn("runs", F.transform(F.sequence(F.lit(0), F.floor((F.size("said") - 1) / RUN).cast("int")), run))
    lengths = F.transform("runs", lambda r: F.aggregate(r, F.lit(0), lambda n, s: n + F.length(s["head"]) + F.length(s["body"])))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(lengths, zero, lambda a, n: F.struct((a["at"] + n).alias("at"), F.array_append(a["starts"], a["at"]).alias("starts")))["starts"]
    placed = runs.withColumn("placed", F.arrays_zip("runs", starts.alias("start")))
    inside = lambda z: F.aggregate(z["runs"], F.struct(z["start"].alias("at"), nothing["spans"].alias("spans")), place)["spans"]
    return placed.select(
        "conv_id", "perspective", F.size("said").cast("long").alias("n_turns"),
        F.size(F.filter("said", lambda s: s["own"])).cast("long").alias("n_own_turns"),
        F.array_join(F.transform("said", lambda s: F.concat(s["head"], s["body"])), "").alias("text"),
        F.flatten(F.transform("placed", inside)).alias("spans"),
    )


def perspective_rows(turns: DataFrame) -> DataFrame:
    """As `perspectives`, with the spans as text (start-end, by commas)."""
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return perspectives(turns).withColumn("mask_spans", spans).drop("spans")


ORACLE = """with t as (select conv_id, turn, replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '|>', '| >') as name,
  replace(coalesce(text, ''), '<|', '< |') as text, row_number() over () as rid, case when conv_id is null then row_number() over () end as lone from conversations),
p as (select distinct conv_id, lone, name as perspective from t where name <> 'system'),
v as (select t.*, p.perspective, name = perspective as own,
  case when name = 'system' then '<|system|>' || chr(10) when name = perspective then '<|assistant|>' || chr(10)
  else '<|user name=' || name || '|>' || chr(10) end as head
  from t join p on t.conv_id is not distinct from p.conv_id and t.lone is not distinct from p.lone),
o as (select *, sum(length(head) + length(text) + 8) over (partition by conv_id, lone, perspective
  order by turn nulls first, name, text, rid rows between unbounded preceding and current row) as stop from v)
select conv_id, perspective, count(*) as n_turns, count(*) filter (own) as n_own_turns,
  string_agg(head || text || '<|end|>' || chr(10), '' order by turn nulls first, name, text, rid) as text,
  coalesce(string_agg(cast(stop - length(text) - 8 as varchar) || '-' || cast(stop as varchar), ',' order by turn nulls first, name, text, rid)
    filter (own), '') as mask_spans
from o group by conv_id, lone, perspective"""
