"""Chat formatting of preference pairs.

A pair has a chosen and a rejected conversation.  Their longest common prefix of turns (equal role and text at equal
places) is rendered once, as the prompt; what follows on each side is rendered as that side's completion.  Only text
that the model has to write bears loss: the body and end mark of assistant turns in a completion; the prompt, other
roles and the role headers are masked.

Everything is a DataFrame of turns: no conversation is gathered in one task.  The end of the common prefix is the least place
at which the digests (SHA-256) of both sides' turns differ; offsets come from sums over spans of turns and a second sum over
the spans, so a conversation with a third of all rows is dealt out too.

Segments are the operator's output: (pair_id, part, turn, n, text, loss) with part prompt, chosen or rejected, the
rendered text of a header or a body, its offset in the part, and whether it bears loss.  ``assemble`` joins them to one
row for each pair.

Defined results: null roles count as ``user``, null texts as empty; turns are ordered by (turn, role, text), repeated
rows are turns of their own; rows with a null pair id belong to no pair and are left out; a pair with equal sides has a
prompt only; a pair with one side has that side only; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = 256


@dataclass(frozen=True)
class Template:
    """A turn is header + text + end; header holds {role}."""

    header: str = "<|{role}|>\n"
    end: str = "<|end|>\n"
    trained_role: str = "assistant"


def _clean(side: DataFrame) -> DataFrame:
    return side.where(F.col("pair_id").isNotNull()).select(
        "pair_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )


def _filled(template: str, role: Column) -> Column:
    before, _, after = template.partition("{role}")
    return F.concat(F.lit(before), role, F.lit(after)) if "{role}" in template else F.lit(template)


def format_sides(both: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments of the pairs of (pair_id, side, turn, role, text), side 0 chosen and 1 rejected, without nulls in role and text.

    Texts are shuffled once, by (pair_id, side, span of turns).  Turns are numbered and their sizes summed within spans; what
    lies before a span is summed over spans, of which a row each is moved.  Turns of both sides meet as digests only.
    """
    keys, size = ["pair_id", "side"], F.length(_filled(template.header, F.col("role"))).cast("long") + F.length(F.concat("text", F.lit(template.end)))
    spanned = both.select(*keys, F.coalesce(F.floor(F.col("turn") / SPAN), F.lit(-1)).alias("span"), "turn", "role", "text")
    order = Window.partitionBy(*keys, "span").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = spanned.repartition(*keys, "span").withColumn("size", size).withColumns({"k": F.row_number().over(order) - 1, "before": F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    sums = turns.groupBy(*keys, "span").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    earlier = Window.partitionBy(*keys).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = sums.select(*keys, "span", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("at"))
    place, start = F.col("first") + F.col("k"), F.col("at") + F.col("before")

    digest = F.sha2(F.concat_ws("\0", F.length("role"), "role", "text"), 256)
    met = turns.join(spans, [*keys, "span"]).select("pair_id", "side", place.alias("place"), start.alias("start"), digest.alias("digest"))
    same = met.groupBy("pair_id", "place").agg(F.min("start").alias("start"), (F.count("*") == 2).alias("two"), F.min("digest").alias("a"), F.max("digest").alias("b"))
    ends = same.where("NOT two OR a <> b").groupBy("pair_id").agg(F.min(F.struct("place", "start")).alias("end"))
    placed = turns.join(spans.join(ends, "pair_id", "left"), [*keys, "span"])
    in_prompt = F.col("end").isNull() | (place < F.col("end.place"))
    part = F.when(in_prompt, F.lit("prompt")).when(F.col("side") == 0, F.lit("chosen")).otherwise(F.lit("rejected"))
    own = F.when(in_prompt, start).otherwise(start - F.col("end.start"))
    rows = placed.where(~in_prompt | (F.col("side") == 0)).select("pair_id", part.alias("part"), place.alias("place"), "role", "text", own.alias("at"))
    header, body = _filled(template.header, F.col("role")), F.concat("text", F.lit(template.end))
    trained = (F.col("part") != "prompt") & (F.col("role") == template.trained_role)
    each = F.array(
        F.struct(F.lit(0).alias("piece"), header.alias("text"), F.col("at").alias("start"), F.lit(False).alias("loss")),
        F.struct(F.lit(1).alias("piece"), body.alias("text"), (F.col("at") + F.length(header)).alias("start"), trained.alias("loss")),
    )
    return rows.select("pair_id", "part", "place", "role", F.explode(each).alias("s")).select("pair_id", "part", "place", "role", "s.*")


def format_pairs(chosen: DataFrame, rejected: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments of the pairs.  chosen and rejected: (pair_id, turn, role, text), a row for each turn.

    Returns pair_id, part, place (of the turn), role, piece (0 header, 1 body), text, start (offset in the part), loss.
    """
    sides = [_clean(df).select("pair_id", F.lit(k).alias("side"), "turn", "role", "text") for k, df in enumerate((chosen, rejected))]
    return format_sides(sides[0].unionByName(sides[1]), template)


def assemble(segments: DataFrame) -> DataFrame:
    """One row for each pair: prompt, chosen, rejected, and the loss spans (start, end) of both completions.

    A row holds a whole pair, so this is for pairs of a size that a row can have.
    """
    own = F.array_sort(F.collect_list(F.struct("start", "text", "loss")))
    parts = segments.groupBy("pair_id", "part").agg(own.alias("s"))
    text = F.array_join(F.transform("s", lambda x: x["text"]), "")
    loss = F.transform(F.filter("s", lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), (x["start"] + F.length(x["text"])).alias("end")))
    parts = parts.select("pair_id", "part", text.alias("text"), loss.alias("loss"))
    pick = lambda part, col: F.max(F.when(F.col("part") == part, F.col(col)))
    return parts.groupBy("pair_id").agg(
        F.coalesce(pick("prompt", "text"), F.lit("")).alias("prompt"),
        *(F.coalesce(pick(side, "text"), F.lit("")).alias(side) for side in ("chosen", "rejected")),
        *(pick(side, "loss").alias(f"{side}_loss") for side in ("chosen", "rejected")),
    )


def last_reply_sides(conversations: DataFrame) -> DataFrame:
    """Both sides, for ``format_sides``, from plain conversations: for tables without preferences.

    Chosen is the conversation as it is; rejected is the same with the text of its last assistant turn replaced by the text of
    the first assistant turn (a stale answer), or of the first turn if there is one assistant turn only.  A conversation without
    an assistant turn is the same on both sides: a prompt.  All turns stay, those after the last reply and those without a number
    too; the latter come first and are never the reply that is replaced.
    """
    one = _clean(conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text"))
    said, known = F.col("role") == "assistant", F.col("turn").isNotNull()
    ends = one.groupBy("pair_id").agg(
        F.max(F.when(said, F.col("turn"))).alias("last"),
        F.min(F.when(said & known, F.struct("turn", "text"))).alias("early"),
        F.min(F.when(known, F.struct("turn", "text"))).alias("start"),
    )
    ends = ends.where(F.col("last").isNotNull()).select("pair_id", "last", F.when(F.col("early.turn") < F.col("last"), F.col("early.text")).otherwise(F.col("start.text")).alias("stale"))
    swapped = F.when((F.col("turn") == F.col("last")) & said, F.col("stale")).otherwise(F.col("text"))
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("text")), F.struct(F.lit(1).alias("side"), swapped.alias("text")))
    return one.join(ends, "pair_id", "left").select("pair_id", "turn", "role", F.explode(sides).alias("s")).select("pair_id", "s.side", "turn", "role", "s.text")
