"""Fixtures for edge cases of the library's operators."""

import pytest
from pyspark.sql import functions as F

from corpuskit.functions import tensors
from corpuskit.functions.text import as_list, changed_files, changed_lines, norm, norm_nonum, shingles, strip_think, title, words
from corpuskit.operators import builds, contamination, dedup, evals, messages, mixture, review, sequences, sweeps, tasks
from corpuskit.plans import grid
from corpuskit.sources import tables
from corpuskit.streaming import ledgers


def one(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {'array<string>' if isinstance(v, list) else 'int' if isinstance(v, int) else 'string'}" for n, v in values.items())) if names else spark.range(1)
    return df.select(column.alias("x")).first()[0]


@pytest.mark.parametrize("text", ["a\x1cb\x1fc", "a\xa0b\u2003c\u3000d\x85e", "  Two  Words ", "", "x"])
def test_norm_equals_python(spark, text):
    assert one(spark, norm(F.col("t")), t=text) == " ".join(text.lower().split())


def test_text_functions(spark):
    assert one(spark, norm_nonum(F.col("t")), t="a 12 ٣٤ b") == "a N N b"
    assert one(spark, words(F.col("t")), t="   ") == []
    assert one(spark, shingles(words(F.col("t")), 3), t="a b c d a b c") == ["a b c", "b c d", "c d a", "d a b"]
    assert one(spark, shingles(words(F.col("t")), 3), t="a b") == ["a b"]
    assert one(spark, shingles(words(F.col("t")), 8, False), t="a b") == []
    assert one(spark, strip_think(F.col("t")), t="<think>x</think> y </think>\n z\n") == "z"
    assert one(spark, title(F.col("t")), t="\n \n## Head\nbody") == "Head"
    assert one(spark, as_list(F.col("t")), t='["a","b"]') == ["a", "b"]
    assert one(spark, as_list(F.col("t")), t="plain") == ["plain"]
    patch = "diff --git a/x.py b/x.py\n--- a/x.py\n+++ b/x.py\n+new\n-old\n same"
    assert one(spark, changed_files(F.col("t")), t=patch) == ["x.py"]
    assert one(spark, changed_lines(F.col("t")), t=patch) == 2


def test_top_k_padding(spark):
    df = spark.createDataFrame([([-0.1 * i for i in range(n)],) for n in (0, 5, 20, 21)], "lp array<double>")
    got = [r[0] for r in df.select(tensors.pad_right(F.col("lp"), 20, F.lit(tensors.PAD_LOGPROB))).collect()]
    assert [len(x) for x in got] == [20] * 4
    assert got[0] == [-1e9] * 20
    with pytest.raises(Exception, match="not a token id"):
        spark.createDataFrame([("token:5",)], "t string").select(tensors.parse_token_id(F.col("t"))).collect()


def test_greedy_chain(spark):
    """A-B and B-C are near, A-C are not: the scan keeps A and C, one pass drops C too."""
    nodes = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id bigint")
    pairs = spark.createDataFrame([(1, 2), (2, 3)], "a bigint, b bigint")
    assert sorted(r[0] for r in dedup.independent_set(nodes, pairs).collect()) == [1, 3, 4]
    members = nodes.withColumn("rep", F.col("id"))
    assert sorted(r[0] for r in dedup.survivors(members, pairs).collect()) == [1, 4]


def test_jaccard_boundary(spark):
    sets = spark.createDataFrame([(1, list("abcdefghi")), (2, list("abcdefgh")), (3, list("abcdx")), (4, [])], "id bigint, grams array<string>")
    assert {(r.a, r.b) for r in dedup.jaccard_pairs(sets).collect()} == {(1, 2)}


def test_gates(spark):
    clean, bad = contamination.gate("a", spark.range(0)), contamination.gate("b", spark.range(2))
    contamination.require(clean)
    with pytest.raises(ValueError, match="b"):
        contamination.require(clean.unionByName(bad))
    with pytest.raises(ValueError):
        tables.require_rows(spark.range(0), "benchmark")
    with pytest.raises(ValueError):
        tables.require_unique(spark.createDataFrame([(1,), (1,)], "k int"), "k")


def test_targets_and_backfill(spark):
    assert sum(r.target for r in mixture.slice_targets(spark, 101).collect()) == 101
    df = spark.createDataFrame([(i, "s", "a" if i < 8 else "b") for i in range(10)], "id int, slice string, source string")
    got = mixture.backfilled(df, "slice", "source", F.col("id"), F.lit(6), F.lit(3)).collect()
    assert len(got) == 6 and sum(r.filled for r in got) == 1
    ids = mixture.dense_ids(df.select("id"), [F.desc("id")], start=5).collect()
    assert {(r.id, r.sample_id) for r in ids} == {(i, 5 + 9 - i) for i in range(10)}


def test_messages(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "assistant", "a"), (1, 2, "tool", "t1"), (1, 3, "tool", "t2"), (1, 4, "assistant", "b"), (1, 5, "user", "u"), (1, 6, "exit", ""), (2, 0, "user", "x"), (3, 0, "robot", "r"), (3, 1, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    kept = messages.clean(df)
    assert {(r.conv_id, r.turn) for r in kept.collect()} == {(1, 0), (1, 1), (1, 2), (1, 3), (1, 4), (3, 0), (3, 1)}
    assert [r.turn for r in kept.where("bad_role").collect()] == [0]
    merged = messages.merge_tool_turns(df.where("conv_id = 1")).orderBy("island").collect()
    assert merged[2].role == "user" and merged[2].n_merged == 2 and "t1" in merged[2].text
    pairs = spark.createDataFrame([(1, i, i % 2 == 0) for i in range(6)] + [(2, 0, True)], "task int, i int, ok boolean")
    assert [(r.chosen, r.rejected) for r in messages.preference_pairs(pairs, "task", "i", "ok").orderBy("place").collect()] == [(0, 1), (0, 3), (0, 5), (2, 1)]


def test_tiers_and_family(spark):
    cases = {(1, 14, 1): "easy", (1, 15, 1): "medium", (2, 10, 1): "medium", (3, 1, 1): "hard", (1, 61, 1): "hard", (1, 1, 6): "hard"}
    df = spark.createDataFrame(list(cases), "f int, l int, t int")
    assert {(r.f, r.l, r.t): r.x for r in df.select("*", tasks.tier(F.col("f"), F.col("l"), F.col("t")).alias("x")).collect()} == cases
    assert one(spark, tasks.malformed(F.col("t")), t="test[a") and not one(spark, tasks.malformed(F.col("t")), t="test[a]")
    assert one(spark, tasks.bug_family(F.lit("x"), F.col("t")), t="a deadlock in a stale cache") == "async_concurrency"


def test_balanced_greedy_keeps_caps(spark):
    pool = spark.createDataFrame([(i, f"r{i % 3}", f"f{i % 2}", i % 5, 0) for i in range(60)], "id bigint, repo string, family string, score int, n_flags int")
    got = tasks.balanced_greedy(pool, 12, repo_cap=4, family_cap=6).collect()
    assert len(got) == 12
    assert max(sum(r.repo == x for r in got) for x in ("r0", "r1", "r2")) <= 4


def test_votes(spark):
    votes = spark.createDataFrame([(1, "tie"), (1, "win"), (1, "loss"), (2, "tie"), (2, "tie"), (2, "win")], "k int, v string")
    assert {(r.k, r.verdict) for r in evals.majority(votes, ["k"], "v").collect()} == {(1, "win"), (2, "tie")}
    for text, want in (("<think>x</think>\n2", (1, True)), ("<think>2", (0, False)), ("9", (0, False)), ("none", (0, False))):
        pick, ok = evals.parsed_choice(F.col("t"), F.lit(3))
        assert one(spark, F.struct(pick, ok), t=text) == want


def test_sources(spark, tmp_path):
    p = str(tmp_path)
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "c", 0)], "id int, v string, seq int")
    tables.append_ledger(df, f"{p}/ledger")
    assert {(r.id, r.v) for r in tables.read_ledger(spark, f"{p}/ledger", df.schema, "id").collect()} == {(1, "b"), (2, "c")}
    tables.write_shards(df, f"{p}/shards", ["id"])
    assert tables.manifest(spark, f"{p}/shards").count() >= 2
    (tmp_path / "tok.json").write_text('{"model": {"vocab": {"a": 0, "b": 1}}, "added_tokens": [{"content": "b", "id": 9}]}')
    assert {(r.token, r.id) for r in tables.read_vocabulary(spark, f"{p}/tok.json").collect()} == {("a", 0), ("b", 9)}
    (tmp_path / "res.json").write_text('{"results": {"t": {"acc": 0.5, "alias": "x", "none": null}}}')
    assert [(r.task, r.metric, r.value) for r in tables.read_results(spark, f"{p}/res.json").collect()] == [("t", "acc", 0.5)]


def test_plans(spark):
    assert grid.problems({"grid": {}, "gate": {}, "budget": {"cap": 1, "reserve": 2}}) == ["reserve is not below cap"]
    got = grid.expand(spark, {"a": [1, 2], "b": ["x", "y", "z"]}).collect()
    assert len(got) == 6 and len({r.trial_id for r in got}) == 6


def test_stream_keeps_state(spark, tmp_path):
    path = f"{tmp_path}/in"
    spark.createDataFrame([("a",), ("b",), ("a",)], "k string").repartition(3).write.parquet(path)
    assert {(r.k, r.n) for r in ledgers.streamed_counts(spark, path, ["k"]).collect()} == {("a", 2), ("b", 1)}
    base = spark.createDataFrame([("b",)], "k string")
    ledgers.streamed_new(ledgers.file_stream(spark, path), base, "k", f"{tmp_path}/out", f"{tmp_path}/state")
    assert [r.k for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["a"]


# ---------------------------------------------------------------- builds, reviews, sequences, sweeps


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_group_places_equal_a_window(spark):
    """Groups larger than a partition, null groups, and empty tables."""
    rows = [(i, None if i % 7 == 0 else "big" if i % 3 else f"g{i % 5}") for i in range(500)]
    got = {r.i: r.place for r in mixture.group_places(frame(spark, "i bigint, g string", *rows).repartition(9), ["g"], [F.col("i")]).collect()}
    seen = {}
    for i, g in rows:
        seen[g] = seen.get(g, 0) + 1
        assert got[i] == seen[g]
    assert mixture.group_places(frame(spark, "i bigint, g string"), ["g"], [F.col("i")]).count() == 0


def test_cascade_names_the_first_reason(spark):
    words_ = " ".join(f"w{i}" for i in range(30))
    near = words_.replace("w29", "zz")
    rows = [(1, words_, "a", "s"), (2, words_, "a", "s"), (3, near, "a", "s"), (4, "a leaked item", "a", "s"), (5, "short one", "a", "s"), (6, "short two", "a", "s"), (7, "short three", "a", "s"), (8, words_, "a", "t"), (9, "short four", None, None)]
    d = frame(spark, "doc_id bigint, text string, lang string, source string", *rows)
    bench = frame(spark, "item_id bigint, text string", (1, "A leaked  item"))
    got = {r.id: r.status for r in builds.cascade(d, bench, "doc_id", "lang", "source", 2).collect()}
    assert got == {1: "kept", 2: "dup", 3: "dup", 4: "benchmark", 5: "kept", 6: "source_cap", 7: "source_cap", 8: "dup", 9: "kept"}
    funnel = {r.slice: r for r in builds.build_funnel(builds.cascade(d, bench, "doc_id", "lang", "source", 2), F.lit(3)).collect()}
    assert (funnel["a"].kept, funnel["a"].backfilled, funnel["a"].dropped_dup, funnel["a"].dropped_benchmark, funnel["a"].dropped_source_cap) == (3, 1, 3, 1, 2)


def test_budgets_follow_the_order_of_sources():
    assert (builds.budget(100, 0.25, 0), builds.budget(100, 0.001, 0), builds.budget(100, 0.9, 95)) == (25, 1, 5)


def test_coverage_must_be_one_to_one(spark):
    a, b = frame(spark, "id bigint", (1,), (2,), (3,)), frame(spark, "id bigint", (2,), (3,), (3,), (4,))
    assert {(r.id, r.side) for r in review.coverage(a, b, "id").collect()} == {(1, "missing"), (3, "repeated"), (4, "extra")}
    review.require_coverage(a, a, "id", "itself")
    with pytest.raises(ValueError, match="one to one"):
        review.require_coverage(a, b, "id", "the other")


def test_queue_selection(spark):
    q = frame(spark, "id bigint, smoke_queue_position bigint", (5, 1), (6, 2), (7, 3))
    assert [r.id for r in review.chosen_only(q, "id", [7, 6], 1).collect()] == [6]
    with pytest.raises(ValueError, match="not in the queue"):
        review.chosen_only(q, "id", [8])


def test_harvested_ids(spark):
    rows = ['{"instance_id": "a"}', '[{"instance_id": "b"}, {"x": 1}, 3, {"instance_id": "a"}]', "not json", "[]", '"text"', None, '{"instance_id": ""}']
    got = review.harvested_ids(frame(spark, "t string", *((r,) for r in rows)), F.col("t"))
    assert sorted(r[0] for r in got.collect()) == ["a", "b"]


def test_append_unique(spark):
    df = frame(spark, "a array<string>, b array<string>", (["x", "x", "y"], ["y", "z", "z"]), (None, ["q"]), (["k"], None))
    assert [r[0] for r in df.select(review.append_unique(F.col("a"), F.col("b"))).collect()] == [["x", "x", "y", "z"], ["q"], ["k"]]


def test_seeds_count_toward_caps(spark):
    pool = frame(spark, "id bigint, repo string, family string, score int, n_flags int", *((i, "r" if i < 6 else f"r{i}", "f", 10 - i % 3, 0) for i in range(12)))
    got = tasks.balanced_greedy(pool, 6, repo_cap=2, seeds=pool.where("id in (0, 1)")).orderBy("pick").collect()
    assert [r.id for r in got[:2]] == [0, 1] and not {r.id for r in got[2:]} & {2, 3, 4, 5}
    with pytest.raises(ValueError, match="one task"):
        tasks.balanced_greedy(pool, 3, most=2)


def test_exact_pack_masks_and_ends(spark):
    schema = "id bigint, slice string, prefix array<int>, resp array<int>, topk_ids array<array<int>>, topk_logprobs array<array<double>>"
    rows = frame(
        spark, schema, (1, "a", [9], [1, 2, 3, 1, 1], [[1, 2]] * 5, [[-0.5, -1.0]] * 5), (2, "a", [9], [2, 2], [[1, 1]] * 2, [[0.0, 0.0]] * 2), (3, "a", [9], [1], [[1, 1]] * 2, [[0.0, 0.0]] * 2), (4, "b", [9], [], [], []), (5, "b", [9], [7], [[1, 1]], [[0.0, 0.0]]),
    )
    remap = frame(spark, "teacher_id int, student_id int", (1, 101), (3, 103), (7, 2))
    packed, account = sequences.pack_exact(rows, remap, eos=2, unk=0, max_len=9, k=2)
    got = {r.id: r for r in packed.collect()}
    assert got[1].input_ids == [9, 101, 0, 103, 101, 101, 2] and got[1].labels == [-100, 101, -100, 103, 101, 101, 2]
    assert got[1].topk_ids[1] == [101, -1] and got[1].topk_logprobs[1] == [-0.5, -1e9] and got[1].topk_ids[-1] == [-1, -1]
    assert got[4].input_ids == [9, 2] and got[5].input_ids == [9, 2] and set(got) == {1, 4, 5}
    assert {r.slice: (r.samples, r.skipped, r.dropped_mostly_unmappable, r.unmappable_positions, r.response_tokens) for r in account.collect()} == {"a": (3, 1, 1, 1, 7), "b": (2, 0, 0, 0, 1)}


def test_text_pack_must_keep_prefix_and_tags(spark):
    rows = frame(spark, "prompt string, reasoning string, answer string", ("hi there", " because ", " yes "), ("hi", None, "no"))
    plain = lambda p, s: (F.concat(F.lit("u "), p), F.concat(F.lit("u "), p, F.lit(" a "), s))
    packed = sequences.pack_text(rows, words, plain, 50)
    assert [(r.prefix_ok, r.tags_ok, r.fits) for r in packed.collect()] == [(True, True, True)] * 2
    assert sequences.require_aligned(packed) is packed
    lossy = lambda p, s: (F.concat(F.lit("u "), p), F.concat(F.lit("u "), p, F.lit(" "), F.regexp_replace(s, "(?s)<think>.*</think>", "")))
    with pytest.raises(ValueError, match="do not survive"):
        sequences.require_aligned(sequences.pack_text(rows, words, lossy, 50))
    other = lambda p, s: (F.concat(F.lit("x "), p), F.concat(F.lit("u "), p, s))
    assert not sequences.pack_text(rows, words, other, 50).where("prefix_ok").count()


def test_collation_and_loss(spark):
    rows = frame(spark, "id bigint, b bigint, input_ids array<int>, labels array<int>", (1, 1, [1, 2, 3], [1, 2, 3]), (2, 1, [4], [4]), (3, 2, [5], [5]))
    got = {r.id: r for r in sequences.collated(rows, "b", 0).collect()}
    assert (got[2].input_ids, got[2].labels, got[2].attention_mask) == ([4, 0, 0], [4, -100, -100], [1, 0, 0]) and got[3].input_ids == [5]
    schema = "id bigint, labels array<int>, logprobs array<double>, student array<array<double>>, teacher array<array<double>>, teacher_ids array<array<int>>"
    same = [[0.5, 0.25]] * 3
    parts = sequences.token_losses(frame(spark, schema, (1, [-100, 4, 5], [-9.0, -1.0, -2.0], same, same, [[1, 2], [1, 2], [-1, -1]])), "id")
    r = parts.first()
    assert (r.n_tokens, r.ce_sum, r.n_teacher, round(r.kl_sum, 9)) == (2, 3.0, 1, 0.0)
    assert sequences.loss_of(parts, 0.5).first().loss == 0.75


def test_teacher_messages(spark):
    schema = "m array<struct<role:string,content:string,reasoning:string,tool_calls:string,tool_call_id:string>>"
    row = [("system", "s", "no", None, None), ("assistant", None, "why", '{"b":1}', None), ("exit", "x", None, None, None), ("tool", "out", None, None, "c1"), ("assistant", "a", "", "not json", "c2")]
    got = frame(spark, schema, (row,)).select(sequences.teacher_messages(F.col("m")), sequences.text_view(F.col("m"))).first()
    assert [tuple(m) for m in got[0]] == [("system", "s", None, None, None), ("assistant", "", "why", '{"b":1}', None), ("tool", "out", None, None, "c1"), ("assistant", "a", None, "not json", None)]
    assert got[1].startswith('sno\nwhy{"b":1}\nx')


def test_instruction_checks(spark):
    schema = "t string, asked array<struct<name:string,args:map<string,string>>>"
    df = frame(spark, schema, ("*one* two", [("no_asterisk", None), ("least_words", {"n": "2"})]), (" \n ", [("no_comma", None)]), ("a\n\nb", [("paragraphs", {"n": "1"})]))
    got = [(r.strict, r.loose) for r in evals.instruction_checks(df, F.col("t"), "asked").collect()]
    assert got == [([False, True], [True, True]), ([False], [False]), ([False], [True])]
    with pytest.raises(Exception, match="no check for instruction"):
        evals.instruction_checks(frame(spark, schema, ("x", [("unheard_of", None)])), F.col("t"), "asked").collect()


def test_sweep_rules(spark):
    trials, attempts = frame(spark, "trial bigint", (1,), (2,), (3,), (4,)), frame(spark, "trial bigint, state string, attempts int, env_digest string, m double", (1, "success", 1, "e", 0.5), (2, "success", 1, "other", 0.9), (3, "failed", 3, None, None))
    base = frame(spark, "env_digest string, m double", ("e", 0.5))
    gated = sweeps.gated_against(trials, attempts, base, {"m": 0.1}, 0.2, 3)
    assert {r.trial: (r.state, r.eligible) for r in gated.collect()} == {1: ("success", True), 2: ("env_drift", False), 3: ("exhausted", False), 4: ("pending", False)}
    assert sweeps.sweep_state(gated).first().sweep == "partial"
    with pytest.raises(ValueError, match="baseline"):
        sweeps.gated_against(trials, attempts, base.limit(0), {"m": 0.1}, 0.2, 3)


def test_sealing_and_resuming(spark, tmp_path):
    expected = frame(spark, "sample_id bigint, shard bigint", *((i, i // 4) for i in range(12)))
    results = frame(spark, "sample_id bigint, dropped string, text string", *((i, "error" if i in (4, 5, 6) else None, f"t{i}") for i in range(11)))
    path = str(tmp_path / "corpus")
    seals = {r.shard: (r.n_rows, r.n_dropped, r.sealed) for r in tables.seal_shards(expected, results, path, "h1", 0.5).collect()}
    assert seals == {0: (4, 0, True), 1: (1, 3, False), 2: (3, 1, True)}
    assert {(r.shard, r.reason): r.n for r in tables.drop_reasons(expected, results).collect()} == {(1, "error"): 3, (2, "missing"): 1}
    assert sorted(r[0] for r in tables.pending_shards(expected, tables.sealed_manifest(spark, path), "h1").select("shard").distinct().collect()) == [1]
    with pytest.raises(ValueError, match="prompts"):
        tables.seal_shards(expected, results, path, "h2")
    again = tables.seal_shards(expected, results.withColumn("dropped", F.lit(None).cast("string")), path, "h1", 0.5)
    assert {r.shard for r in again.where("sealed").collect()} == {1}
    assert spark.read.parquet(f"{path}/rows").count() == 4 + 3 + 4


def test_corpus_and_samples(spark, tmp_path):
    rows = frame(spark, "sample_id bigint, prompt string", (0, "a"), (1, "b"))
    about = tables.write_corpus(rows, rows.limit(1), frame(spark, "slice string, kept bigint", ("x", 2)), str(tmp_path / "out"))
    assert about["prompts"]["rows"] == 2 and about["prompts"]["digest"] != about["prompts_heldout"]["digest"]
    tables.write_report(rows, str(tmp_path / "out" / "funnel"))
    assert tables.read_samples(spark, f"{tmp_path}/out/prompts/*.json", tables.PROMPTS).count() == 2
    with pytest.raises(ValueError, match="no sample files"):
        tables.read_samples(spark, f"{tmp_path}/none/*.json", tables.PROMPTS)
    with pytest.raises(ValueError, match="lacks gate"):
        tables.read_plan('{"grid": {}}', ("grid", "gate"))
    tensors_ = frame(spark, "id bigint, lp array<array<double>>", (1, [[0.0, 1.0]]))
    tables.write_tensors(tensors_, str(tmp_path / "t"), {"lp": 2})
    with pytest.raises(ValueError, match="shape"):
        tables.write_tensors(tensors_, str(tmp_path / "t2"), {"lp": 3})
    tables.write_split(rows.withColumn("split", F.lit("train")), str(tmp_path / "s"))
    assert (tmp_path / "s" / "split=train").is_dir()


def test_gate_of_tasks(spark):
    text = " ".join(f"w{i}" for i in range(40))
    mine = frame(spark, "id bigint, repo string, text string", (1, "a", text + " more words behind"), (2, "b", "other"), (3, "c", "Same  TEXT"))
    held = frame(spark, "id bigint, repo string, text string", (2, "z", text), (9, "c", "same text"))
    got = {r.id: (r.instance, r.repo, r.text_exact, r.text_ngram) for r in builds.gate_tasks(mine, held).collect()}
    assert got == {1: (False, False, False, True), 2: (True, False, False, False), 3: (False, True, True, False)}
    assert builds.gate_report(builds.gate_tasks(mine.where("id = 1"), held.where("id = 9"))).first().verdict == "CLEAN"
