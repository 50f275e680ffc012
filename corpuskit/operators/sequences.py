"""Packing of token sequences: exact reuse of teacher tokens, retokenized text, collation, trajectories, loss audits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tensors import IGNORE, PAD_ID, PAD_LOGPROB, TOP_K, topk_kl
from ..functions.text import strip_white
from .messages import ROLES

#: A sequence with a larger share of tokens without a counterpart is dropped.
UNMAPPABLE = 0.2


def pack_exact(rows: DataFrame, remap: DataFrame, eos: int, unk: int, max_len: int, k: int = TOP_K, unmappable: float = UNMAPPABLE) -> tuple[DataFrame, DataFrame]:
    """Teacher sequences in the student's vocabulary, and the accounting of each slice.

    ``rows`` has ``id``, ``slice``, ``prefix`` and ``resp`` (token ids), ``topk_ids`` and ``topk_logprobs`` (one list of
    ``k`` per token of ``resp``); ``remap`` has ``teacher_id`` and ``student_id``. A token without a counterpart becomes
    ``unk`` and its label is ignored; such top-K entries are padded. An end token without a teacher distribution is
    added where there is none. Dropped: lists of unlike length, mostly unmappable sequences, sequences above ``max_len``.
    The remap table meets the tokens in a join, so vocabularies of any size will do.
    """
    fits = F.size("resp") == F.size("topk_ids")
    long = rows.where(fits).select("id", F.posexplode(F.arrays_zip("resp", "topk_ids", "topk_logprobs")).alias("pos", "x"))
    said = remap.select(F.col("teacher_id").alias("__t"), F.col("student_id").alias("__s"))
    own = long.select("id", "pos", F.col("x.resp").alias("token")).join(said, F.col("token") == F.col("__t"), "left").select("id", "pos", F.col("__s").cast("int").alias("mapped"))
    top = long.select("id", "pos", F.posexplode(F.arrays_zip("x.topk_ids", "x.topk_logprobs")).alias("rank", "e")).select("id", "pos", "rank", F.col("e")["topk_ids"].alias("token"), F.col("e")["topk_logprobs"].cast("double").alias("lp"))
    top = top.join(said, F.col("token") == F.col("__t"), "left")
    entry = F.struct("rank", F.coalesce("__s", F.lit(PAD_ID)).cast("int").alias("i"), F.when(F.col("__s").isNotNull(), F.col("lp")).otherwise(PAD_LOGPROB).alias("l"))
    top = top.groupBy("id", "pos").agg(F.sort_array(F.collect_list(entry)).alias("top"))
    tokens = own.join(top, ["id", "pos"], "left").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "mapped", "top"))).alias("t"), F.count("*").alias("n_tokens"), F.count_if(F.col("mapped").isNull()).alias("n_unmapped")
    )
    met = rows.withColumn("__fits", fits).join(tokens, "id", "left").withColumns({"n_tokens": F.coalesce("n_tokens", F.lit(0)), "n_unmapped": F.coalesce("n_unmapped", F.lit(0))})
    mostly = F.col("n_unmapped") > F.greatest(F.col("n_tokens"), F.lit(1)) * unmappable
    t = F.coalesce("t", F.array().cast("array<struct<pos:int,mapped:int,top:array<struct<rank:int,i:int,l:double>>>>"))
    ids = F.transform(t, lambda x: F.coalesce(x["mapped"], F.lit(unk)).cast("int"))
    labels = F.transform(t, lambda x: F.coalesce(x["mapped"], F.lit(IGNORE)).cast("int"))
    lists = lambda f: F.transform(t, lambda x: F.transform(x["top"], lambda e: e[f]))
    pad_ids, pad_lps = F.array_repeat(F.lit(PAD_ID), k), F.array_repeat(F.lit(PAD_LOGPROB), k)
    ends = F.coalesce(F.try_element_at(ids, F.lit(-1)) == eos, F.lit(False))
    tail = lambda a, x: F.when(ends, a).otherwise(F.concat(a, F.array(x)))
    head = lambda x: F.transform("prefix", lambda _: x)
    packed = met.where(F.col("__fits") & ~mostly).select(
        "id", "slice", F.concat(F.transform("prefix", lambda x: x.cast("int")), tail(ids, F.lit(eos))).alias("input_ids"), F.concat(head(F.lit(IGNORE)), tail(labels, F.lit(eos))).alias("labels"),
        F.concat(head(pad_ids), tail(lists("i"), pad_ids)).alias("topk_ids"), F.concat(head(pad_lps), tail(lists("l"), pad_lps)).alias("topk_logprobs"),
    )
    length = F.size("prefix") + F.size(ids) + F.when(ends, 0).otherwise(1)
    counted = met.select("slice", F.col("__fits").alias("fits"), mostly.alias("mostly"), "n_tokens", "n_unmapped", (length > max_len).alias("over"))
    account = counted.groupBy("slice").agg(
        F.count("*").alias("samples"), F.count_if(~F.col("fits") | (~F.col("mostly") & F.col("over"))).alias("skipped"), F.count_if(F.col("fits") & F.col("mostly")).alias("dropped_mostly_unmappable"),
        F.coalesce(F.sum(F.when(F.col("fits") & ~F.col("mostly"), F.col("n_unmapped"))), F.lit(0)).alias("unmappable_positions"), F.coalesce(F.sum(F.when(F.col("fits"), F.col("n_tokens"))), F.lit(0)).alias("response_tokens"),
    )
    return packed.where(F.size("input_ids") <= max_len), account


def wrapped_answer(reasoning: Column, answer: Column, tags: tuple[str, str] | None) -> Column:
    """The answer behind its reasoning, inside the student's think tags where it has some."""
    thought, said = strip_white(F.coalesce(reasoning, F.lit(""))), strip_white(F.coalesce(answer, F.lit("")))
    full = F.concat(thought, F.lit("\n\n"), said) if tags is None else F.concat(F.lit(tags[0] + "\n"), thought, F.lit("\n" + tags[1] + "\n\n"), said)
    return F.when(thought != "", full).otherwise(said)


def pack_text(rows: DataFrame, tokenize: Callable[[Column], Column], render: Callable[[Column, Column], tuple[Column, Column]], max_len: int, tags: tuple[str, str] | None = ("<think>", "</think>")) -> DataFrame:
    """``rows`` (``prompt``, ``reasoning``, ``answer``) as tokens, with what is wrong with each sequence.

    ``render`` gives the prefix and the whole conversation as text, ``tokenize`` an array of tokens for a text.
    ``prefix_ok``: the prefix's tokens begin the conversation's, so that labels line up. ``tags_ok``: the closing tag
    is still there behind the prefix where there is reasoning. ``fits``: the answer is not empty and not too long.
    """
    said = wrapped_answer(F.col("reasoning"), F.col("answer"), tags)
    prefix, full = render(F.col("prompt"), said)
    met = rows.withColumns({"prefix": tokenize(prefix), "full": tokenize(full)})
    n = F.size("prefix")
    behind = F.slice("full", n + 1, F.greatest(F.size("full") - n, F.lit(0)))
    thinks = strip_white(F.coalesce("reasoning", F.lit(""))) != ""
    kept = F.exists(behind, lambda x: F.contains(x.cast("string"), F.lit(tags[1]))) if tags else F.lit(True)
    return met.withColumns({
        "prefix_ok": F.slice("full", F.lit(1), n) == F.col("prefix"), "tags_ok": ~thinks | kept, "fits": (F.size("full") > n) & (F.size("full") <= max_len),
        "labels": F.concat(F.transform("prefix", lambda _: F.lit(None).cast("string")), F.transform(behind, lambda x: x.cast("string"))),
    })


def require_aligned(packed: DataFrame) -> DataFrame:
    """``packed`` of ``pack_text``, or an error where labels would be out of place or reasoning be lost."""
    bad = packed.where("not prefix_ok or not tags_ok").limit(1).collect()
    if bad:
        raise ValueError(f"prefix or think tags do not survive the template: {bad[0].asDict()}")
    return packed


def collated(rows: DataFrame, batch: str, pad: int) -> DataFrame:
    """``rows`` (``input_ids``, ``labels``) padded to the longest of their batch, with ``attention_mask``."""
    longest = rows.groupBy(batch).agg(F.max(F.size("input_ids")).alias("__most"))
    met = rows.join(longest, batch)
    room = F.col("__most") - F.size("input_ids")
    fill = lambda c, x: F.concat(c, F.array_repeat(F.lit(x).cast("int"), room))
    ones = F.array_repeat(F.lit(1), F.size("input_ids"))
    return met.select(*[c for c in rows.columns if c not in ("input_ids", "labels")], fill("input_ids", pad).alias("input_ids"), fill("labels", IGNORE).alias("labels"), fill(ones, 0).alias("attention_mask"))


def token_losses(rows: DataFrame, key: str, temperature: float = 2.0) -> DataFrame:
    """Loss parts of each row: tokens that count, summed cross entropy, positions with a teacher, summed divergence.

    ``rows`` has ``labels``, ``logprobs`` (of each label), ``student`` and ``teacher`` (top-K lists per position) and
    ``teacher_ids``. A position counts if its label does; for the divergence it also needs one teacher entry that is
    no pad. Padded entries are pads on both sides.
    """
    long = rows.select(key, F.posexplode(F.arrays_zip("labels", "logprobs", "student", "teacher", "teacher_ids")).alias("pos", "x")).select(key, "x.*")
    pads = F.transform("teacher_ids", lambda i: i == PAD_ID)
    clear = lambda c: F.zip_with(c, pads, lambda v, p: F.when(p, F.lit(PAD_LOGPROB)).otherwise(v.cast("double")))
    counts = F.col("labels") != IGNORE
    valid = counts & ~F.forall("teacher_ids", lambda i: i == PAD_ID)
    return long.groupBy(key).agg(
        F.count_if(counts).alias("n_tokens"), F.coalesce(F.sum(F.when(counts, -F.col("logprobs").cast("double"))), F.lit(0.0)).alias("ce_sum"),
        F.count_if(valid).alias("n_teacher"), F.coalesce(F.sum(F.when(valid, topk_kl(clear("student"), clear("teacher"), temperature))), F.lit(0.0)).alias("kl_sum"),
    )


def loss_of(parts: DataFrame, alpha: float) -> DataFrame:
    """One row: the blend of cross entropy and divergence over all rows of ``token_losses``."""
    ce = F.sum("ce_sum") / F.greatest(F.sum("n_tokens"), F.lit(1))
    kl = F.sum("kl_sum") / F.greatest(F.sum("n_teacher"), F.lit(1))
    return parts.agg(ce.alias("ce"), kl.alias("kl"), ((1 - alpha) * ce + alpha * kl).alias("loss"))


def teacher_messages(messages: Column) -> Column:
    """Messages of known roles as the teacher's template reads them; what a role does not have is null.

    ``reasoning`` of the assistant becomes ``reasoning_content``, its calls stay (their arguments as parsed JSON text if
    they are JSON, else as they are), and ``tool_call_id`` stays with tool messages.
    """
    known = F.filter(messages, lambda m: m["role"].isin(*ROLES))
    reply = lambda m, v: F.when((m["role"] == "assistant") & (F.coalesce(v, F.lit("")) != ""), v)
    return F.transform(known, lambda m: F.struct(
        m["role"].alias("role"), F.coalesce(m["content"], F.lit("")).alias("content"), reply(m, m["reasoning"]).alias("reasoning_content"),
        reply(m, F.coalesce(F.to_json(F.try_parse_json(m["tool_calls"])), m["tool_calls"])).alias("tool_calls"), F.when((m["role"] == "tool") & (F.coalesce(m["tool_call_id"], F.lit("")) != ""), m["tool_call_id"]).alias("tool_call_id"),
    ))


def text_view(messages: Column) -> Column:
    """Content, reasoning and calls of all messages, one after the other, a line for each message."""
    empty = lambda v: F.coalesce(v, F.lit(""))
    return F.array_join(F.transform(messages, lambda m: F.concat(empty(m["content"]), empty(m["reasoning"]), empty(m["tool_calls"]))), "\n")


def pack_trajectories(ledger: DataFrame, trajectories: DataFrame, cap: int, history: str) -> DataFrame:
    """Verified rollouts of the ledger with their messages, provenance and size.

    ``ledger`` has ``instance_id``, ``rollout``, ``verified`` and further columns, which are kept; ``trajectories`` has
    the key and ``messages``. A verified rollout without messages, or without a turn of the assistant, is a
    ``clean_error``. Sizes are estimated at 3.5 characters a token.
    """
    met = ledger.where("verified").join(trajectories, ["instance_id", "rollout"], "left")
    kept = F.filter("messages", lambda m: m["role"].isin(*ROLES))
    size = F.floor(F.char_length(text_view(kept)) / 3.5).cast("bigint")
    turns = F.size(F.filter(kept, lambda m: m["role"] == "assistant"))
    calls = F.exists(kept, lambda m: F.coalesce(m["tool_calls"], F.lit("")).rlike(history) | F.coalesce(m["content"], F.lit("")).rlike(history))
    out = met.withColumns({"clean_error": F.col("messages").isNull() | (F.coalesce(turns, F.lit(0)) <= 0), "n_messages": F.size(kept), "n_assistant_turns": turns, "est_tokens": size, "history_assisted": calls})
    return out.withColumns({"over_token_cap": F.col("est_tokens") > cap, "messages": kept})


def trajectory_funnel(ledger: DataFrame, packed: DataFrame) -> DataFrame:
    """One row of counts from tasks to packed rollouts."""
    a = ledger.agg(F.countDistinct("instance_id").alias("tasks"), F.count("*").alias("rollouts"), F.count_if("verified").alias("verified"))
    b = packed.agg(F.count_if(~F.col("clean_error")).alias("packed"), F.count_if(~F.col("clean_error") & F.col("over_token_cap")).alias("over_cap"), F.count_if("clean_error").alias("clean_errors"))
    both = a.unionByName(b, allowMissingColumns=True)
    return both.agg(*(F.sum(c).alias(c) for c in both.columns))
