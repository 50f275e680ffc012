"""Conversations: cleaning, linkage, islands, rendering, loss masks, preference pairs, top-K and vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Known roles, the role that is bookkeeping, and the look into version history.
ROLES = ("system", "user", "assistant", "tool")
EXIT = "exit"
GIT_HISTORY = r"git\s+(log|show|tag|describe|reflog|cherry|branch\s+-[ar])"


def ordered(conv: str, turn: str) -> Window:
    return Window.partitionBy(conv).orderBy(turn)


def clean(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role") -> DataFrame:
    """Turns up to the last of the assistant, bookkeeping left out, with ``bad_role`` for unknown roles."""
    kept = turns.where(F.col(role) != EXIT).withColumn("bad_role", ~F.col(role).isin(*ROLES))
    last = kept.where(F.col(role) == "assistant").groupBy(conv).agg(F.max(turn).alias("__last"))
    return kept.join(last, conv).where(F.col(turn) <= F.col("__last")).drop("__last")


def linked(turns: DataFrame, conv: str, turn: str, role: str, call_ids: Column, call_id: Column) -> DataFrame:
    """Turns with ``linked``: whether a tool turn answers a call of the latest assistant turn before it (else null)."""
    ids = F.when(F.col(role) == "assistant", F.coalesce(call_ids, F.array().cast("array<string>")))
    open_ = F.last(ids, ignorenulls=True).over(ordered(conv, turn).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ok = F.coalesce(F.array_contains(F.coalesce(open_, F.array().cast("array<string>")), call_id), F.lit(False))
    return turns.withColumn("linked", F.when(F.col(role) == "tool", ok))


def merge_tool_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, island, role, first_turn, n_merged, text)``: consecutive tool turns become one user turn."""
    w = ordered(conv, turn)
    starts = (F.col(role) != "tool") | (F.coalesce(F.lag(role).over(w), F.lit("")) != "tool")
    islands = turns.withColumn("island", F.sum(starts.cast("int")).over(w))
    tool = F.concat(F.lit("<tool_response>\n"), F.col(text), F.lit("\n</tool_response>"))
    said = F.when(F.col(role) == "tool", tool).otherwise(F.col(text))
    merged = islands.withColumn("__said", said).groupBy(conv, "island").agg(
        F.min(role).alias("r"), F.min(turn).alias("first_turn"), F.count("*").alias("n_merged"), F.sort_array(F.collect_list(F.struct(turn, "__said"))).alias("p")
    )
    return merged.select(conv, "island", F.when(F.col("r") == "tool", "user").otherwise(F.col("r")).alias("role"), "first_turn", "n_merged", F.array_join(F.transform("p", lambda x: x["__said"]), "\n").alias("text"))


def render(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """ChatML segments ``(conv, turn, pos, segment, trainable)``: an assistant's header and line end do not train."""
    c = F.col(text)
    body = F.concat(F.lit("<think>\n\n</think>\n\n"), c, F.lit("<|im_end|>"))
    part = lambda s, t: F.struct(s.alias("segment"), F.lit(t).alias("trainable"))
    reply = F.array(part(F.lit("<|im_start|>assistant\n"), False), part(body, True), part(F.lit("\n"), False))
    other = F.array(part(F.concat(F.lit("<|im_start|>"), F.col(role), F.lit("\n"), c, F.lit("<|im_end|>\n")), False))
    segments = F.when(F.col(role) == "assistant", reply).otherwise(other)
    return turns.select(conv, turn, F.posexplode(segments).alias("pos", "s")).select(conv, turn, "pos", "s.segment", "s.trainable")


def running_ranges(turns: DataFrame, size: Column, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Turns with ``begin`` and ``end``: the range of each in the concatenation of its conversation."""
    end = F.sum(size).over(ordered(conv, turn).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return turns.withColumn("end", end).withColumn("begin", F.col("end") - size)


def preference_pairs(rollouts: DataFrame, task: str, index: str, good: str, most: int = 4) -> DataFrame:
    """``(task, chosen, rejected, place)``: verified against unverified rollouts, at most ``most`` a task.

    The first ``most`` of either side suffice for the first pairs in (chosen, rejected) order, so no task's product
    of rollouts is ever built.
    """
    w = Window.partitionBy(task, good).orderBy(index)
    head = rollouts.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most)
    a = head.where(F.col(good)).select(task, F.col(index).alias("chosen"))
    b = head.where(~F.col(good)).select(task, F.col(index).alias("rejected"))
    pairs = a.join(b, task).withColumn("place", F.row_number().over(Window.partitionBy(task).orderBy("chosen", "rejected")))
    return pairs.where(F.col("place") <= most)


def vocabulary_counts(teacher: DataFrame, student: DataFrame, most_missing: float = 0.10) -> DataFrame:
    """One row of vocabulary counts with ``kd_mode``: exact, remap or none. Inputs are ``(token, id)``."""
    t, s = teacher.select("token", F.col("id").alias("t")), student.select("token", F.col("id").alias("s"))
    row = t.join(s, "token", "full").agg(
        F.count("t").alias("teacher_vocab"), F.count("s").alias("student_vocab"),
        F.count_if(F.col("s").isNull()).alias("only_teacher"), F.count_if(F.col("t").isNull()).alias("only_student"),
        F.count_if(F.col("t") != F.col("s")).alias("moved"),
    )
    missing = F.col("only_teacher") / F.greatest(F.col("teacher_vocab"), F.lit(1))
    mode = F.when((F.col("only_teacher") == 0) & (F.col("moved") == 0), "exact").when(missing <= most_missing, "remap").otherwise("none")
    return row.select("*", missing.alias("missing_frac"), mode.alias("kd_mode"))


def remap_table(teacher: DataFrame, student: DataFrame) -> DataFrame:
    """``(teacher_id, student_id)`` of the tokens that both vocabularies hold."""
    return teacher.select("token", F.col("id").alias("teacher_id")).join(student.select("token", F.col("id").alias("student_id")), "token").select("teacher_id", "student_id")


def remapped(rows: DataFrame, key: str, ids: str, table: DataFrame, ignore: int = -100) -> DataFrame:
    """``(key, labels, n_tokens, n_unmapped)``: token ids through the remap table, ``ignore`` where there is none."""
    long = rows.select(key, F.posexplode(ids).alias("pos", "id"))
    met = long.join(table, long["id"] == table["teacher_id"], "left")
    packed = met.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("student_id", F.lit(ignore)).alias("l")))).alias("p"), F.count("*").alias("n_tokens"), F.count_if(F.col("student_id").isNull()).alias("n_unmapped"))
    return packed.select(key, F.transform("p", lambda x: x["l"]).alias("labels"), "n_tokens", "n_unmapped")
