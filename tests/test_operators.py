import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.functions.techniques import LAYER_CAPS, all_techniques, compatible, registry_frame, technique_pool
from millrace.functions.text import text_cell
from millrace.operators import conversations, generation, model_steps, planning, relational, search, telemetry
from millrace.operators.ledger import Ledger, Locked, finished_lines
from millrace.plans import recipe
from millrace.sources import artifacts
from millrace.streaming import jobs


def test_take_per_group_drops_null_groups(spark):
    rows = spark.createDataFrame([(k, "a" if k % 2 else None, k % 3) for k in range(12)], "pos int, category string, entry_type int")
    kept = relational.take_per_group(rows, 1, "pos")
    assert {r.pos for r in kept.collect()} == {1, 3, 5}
    assert relational.take_per_group(rows, None, "pos") is rows
    assert [r.pos for r in relational.take_per_group(rows.select("pos"), 2, "pos").collect()] == [0, 1]


def test_parts_and_counts(spark):
    a = spark.createDataFrame([("x", "True"), ("y", "yes")], "sample string, accepted string")
    b = spark.createDataFrame([("z", 1)], "sample string, extra int")
    union = relational.union_parts([relational.Part(a, "a", True), relational.Part(b, "b")])
    assert union.columns == ["sample", "accepted", "dataset_type", "extra"]
    assert {(r.sample, r.dataset_type, r.extra) for r in union.collect()} == {("x", "a", None), ("z", "b", 1)}
    assert tuple(relational.file_counts(a).first()) == (2, 1)
    assert tuple(relational.file_counts(b).first()) == (1, None)


def test_pending_and_last_input(spark):
    plan = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("c", 0)], "sample_id string, iteration int")
    inputs = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 3, "x")], "sample_id string, pos int, text string")
    acks = spark.createDataFrame([("a", 1)], "sample_id string, iteration int")
    assert {(r.sample_id, r.iteration) for r in relational.pending(plan, inputs, acks).collect()} == {("a", 0), ("b", 0)}
    assert {r.sample_id: r.text for r in relational.last_input(inputs, "pos").collect()} == {"a": "new", "b": "x"}


def test_interval_union_by_brute_force(spark):
    rng = random.Random(3)
    spans = [(rng.randint(0, 2), float(s := rng.randint(0, 50)), float(s + rng.randint(0, 9))) for _ in range(60)]
    frame = spark.createDataFrame(spans, "k int, s double, e double")
    got = {r.k: r.covered_s for r in telemetry.covered_seconds(frame, F.col("s"), F.col("e"), ("k",)).collect()}
    assert got == {k: len({x for g, s, e in spans if g == k for x in range(int(s), int(e))}) for k in {g for g, _, _ in spans}}


def test_costs(spark):
    events = spark.createDataFrame([("call", "m", "api", 1, 1000000, 0, 1.0, False, None, "s"), ("call", "l", "vllm", 1, 5, 5, 1.0, True, "x", "s"), ("stage", "m", None, 0, 0, 0, 0.0, False, None, None)], "ev string, model string, backend string, n_items int, in_tok int, out_tok int, ms double, cut boolean, error string, stage string")
    prices = spark.createDataFrame([("m", 2.0, None), ("l", 1.0, 1.0)], "model string, price_in double, price_out double")
    per = telemetry.usage(events, prices)
    assert {r.model: (r.calls, r.cost_usd, r.cut, r.errors) for r in per.collect()} == {"m": (1, 2.0, 0, 0), "l": (1, None, 1, 1)}
    assert telemetry.total_cost(per).first()[0] == 2.0
    assert telemetry.total_cost(per.where("model = 'l'")).first()[0] == 0.0
    rates = spark.createDataFrame([("p", "g", 1.0), ("*", "g", 2.0)], "provider string, gpu string, rate double")
    got = telemetry.hourly_rate(spark.createDataFrame([("p", "g"), ("q", "g"), ("q", "h")], "provider string, gpu string"), rates)
    assert {(r.provider, r.gpu): r.rate for r in got.collect()} == {("p", "g"): 1.0, ("q", "g"): 2.0, ("q", "h"): None}


def test_plan_is_dealt_evenly_and_repeats(spark):
    inputs = spark.createDataFrame([(f"s{k:03}", "c", "e") for k in range(60)], "sample_id string, category string, entry_type string")
    pool = technique_pool(families=("encode", "casual_writing", "framing", "indirect"))
    rounds = ({}, {"exact": 2})
    rows = planning.plan(inputs, pool, rounds=rounds).collect()
    assert len(rows) == 120 and sorted(rows) == sorted(planning.plan(inputs.repartition(7), pool, rounds=rounds).collect())
    known = {t.name: t for t in all_techniques()}
    hacking = sum(any(known[n].layer == "hacking" for n in r.combination) for r in rows if r.iteration == 0)
    assert 29 <= hacking <= 31
    assert all(len(r.combination) == 2 for r in rows if r.iteration == 1)
    per_sample = Counter((r.sample_id, tuple(r.combination)) for r in rows)
    assert max(per_sample.values()) == 1
    short = planning.short_layers(planning.plan(inputs, pool, rounds=rounds[:1]), registry_frame(spark), {"manipulation": 0.5})
    assert [(r.layer, r.target, r.n) for r in short.collect()] == [("manipulation", 30, 0)]


def test_plan_in_parts_with_weights(spark):
    inputs = spark.createDataFrame([(f"s{k:04}", "c" if k % 3 else None, "e") for k in range(600)], "sample_id string, category string, entry_type string")
    pool = technique_pool(pure_only=True)
    known = {t.name: t for t in all_techniques()}
    rows = planning.plan(inputs, pool, rounds=planning.ESCALATION, part_units=100, weights={"framing": 2.0}).collect()
    assert len(rows) == 2400 and {r.category for r in rows} == {"c", ""}
    for k, settings in enumerate(planning.ESCALATION):
        mine = [[known[n] for n in r.combination] for r in rows if r.iteration == k]
        for picks in mine:
            assert all(a is b or compatible(a, b) for a in picks for b in picks)
            assert all(sum(t.layer == layer for t in picks) <= cap for layer, cap in LAYER_CAPS.items())
            if "exact" in settings:
                assert len(picks) == settings["exact"]
            else:
                assert sum(t.complexity for t in picks) <= settings["max_complexity"]
        if "rates" in settings:
            share = sum(any(t.layer == "hacking" for t in picks) for picks in mine) / len(mine)
            assert abs(share - settings["rates"]["hacking"]) < 0.02
    turns = Counter(t.families[0] for r in rows for t in map(known.get, r.combination) if r.iteration == 0)
    assert 1.5 < turns["framing"] / turns["encode"] < 2.5


def test_ledger_resumes_and_drops(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"), "sample_id string")
    plan = spark.createDataFrame([("a",), ("b",), ("c",)], "sample_id string")
    assert ledger.pending(plan).count() == 3
    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "sample_id string, text string")
    acks = rows.select("sample_id", F.lit("done").alias("status"))
    save = ledger.commit(rows, acks)
    again = ledger.commit(rows, acks, source="x")
    assert save == 1 and again == 2 and ledger.commit(rows.limit(0), acks.limit(0), source="x") == 2  # a source commits once
    ledger.drop(rows.limit(0), "sample_id string, text string")
    assert ledger.rows("sample_id string, text string").count() == 4 and [r.save for r in ledger.commits().collect()] == [3]
    assert {r.sample_id for r in ledger.pending(plan).collect()} == {"c"}
    ledger._write(plan, "rows", 9)  # a save that was cut off before its commit
    assert ledger.rows("sample_id string, text string").count() == 4 and ledger.torn().count() == 0
    ledger.drop(plan.where("sample_id = 'a'"), "sample_id string, text string")
    assert {r.sample_id for r in ledger.pending(plan).collect()} == {"a", "c"}
    lines = spark.createDataFrame([(0, "a", None), (1, "b", "x"), (2, "c", None)], "pos int, id string, saved string")
    assert {r.id for r in finished_lines(lines, ["id"]).collect()} == {"a", "b"}
    assert finished_lines(lines.where("saved IS NULL"), ["id"]).count() == 2


def test_ledger_survives_what_fails(spark, tmp_path, monkeypatch):
    ledger, schema = Ledger(spark, str(tmp_path / "l"), "sample_id string"), "sample_id string, text string"
    rows = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], schema)
    acks = rows.select("sample_id", F.lit("done").alias("status"))
    ledger.commit(rows, acks)
    plain = Ledger._write
    for part in ("rows", "acks", "commits"):

        def fails(self, frame, name, save, part=part):
            if name == part:
                raise OSError("disk full")
            plain(self, frame, name, save)

        monkeypatch.setattr(Ledger, "_write", fails)
        with pytest.raises(OSError, match="disk full"):
            ledger.drop(rows.where("sample_id = 'a'"), schema)
        with pytest.raises(OSError, match="disk full"):
            ledger.commit(rows, acks)
        assert ledger.acks().count() == 3 and ledger.rows(schema).count() == 3
    monkeypatch.setattr(Ledger, "_write", plain)
    ledger.drop(rows.where("sample_id = 'a'"), schema)
    assert {r.sample_id for r in ledger.acks().collect()} == {"b", "c"} == {r.sample_id for r in ledger.rows(schema).collect()}
    # rows that differ each time they are computed are written once
    shaky = spark.range(50).select(F.uuid().alias("sample_id"), F.lit("t").alias("text"))
    ledger.commit(shaky, shaky.select("sample_id", F.lit("done").alias("status")))
    assert ledger.torn().count() == 0
    with ledger._alone():
        with pytest.raises(Locked):
            ledger.commit(rows, acks)
    with pytest.raises(ZeroDivisionError), ledger._alone():
        1 / 0
    assert not ledger.release_lock()
    ledger._file("_lock")[1].create(ledger._file("_lock")[0], False).close()
    assert ledger.release_lock() and ledger.commit(rows, acks) == 4
    ledger._write(rows.limit(1), "rows", 4)
    assert [(r.save, r.part, r.wanted, r.found) for r in ledger.torn().collect()] == [(4, "rows", 3, 1)]


def test_a_stream_replaces_no_save(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"), "sample string")
    first = spark.createDataFrame([("a",), ("b",)], "sample string")
    done = lambda units: (units, units.select("sample", F.lit("done").alias("status")))
    ledger.commit(*done(first))
    spark.createDataFrame([("c",), ("a",)], "sample string").write.json(str(tmp_path / "in"))
    for checkpoint in ("one", "two"):
        stream = jobs.read_events(spark, str(tmp_path / "in"), "sample string")
        jobs.commit_units(stream, ledger, done, str(tmp_path / checkpoint)).awaitTermination(60)
        assert {r["sample"] for r in ledger.acks().collect()} == {"a", "b", "c"} and ledger.rows("sample string").count() == 3
    sources = [r.source for r in ledger.commits().orderBy("save").collect()]
    assert sources[0] is None and len(set(sources)) == 3 and all(x.endswith(":0") and len(x) == 38 for x in sources[1:])


def test_csv_artifacts(spark, tmp_path):
    path, schema = str(tmp_path / "a"), "id string, text string, n int"
    assert artifacts.read_rows(spark, path, schema).count() == 0
    rows = spark.createDataFrame([("1", 'a,"b"\nc', 1), ("2", "nan", None)], schema)
    artifacts.append_rows(rows, path, schema)
    artifacts.append_rows(rows.select("id"), path, schema)
    back = artifacts.read_rows(spark, path, schema)
    assert sorted((r.id, r.text) for r in back.collect() if r.text) == [("1", 'a,"b"\nc'), ("2", "nan")]
    assert artifacts.read_rows(spark, path, schema, na_to_null=True).where("text IS NOT NULL").count() == 1
    with pytest.raises(ValueError, match="not in the artifact"):
        artifacts.append_rows(rows.withColumn("other", F.lit(1)), path, schema)


def test_csv_cells_keep_blanks_and_marked_texts(spark, tmp_path):
    path, texts = str(tmp_path / "a"), [" a ", "\r", '\x00"', "nan", "\\nan", "", " ", "\n"]
    rows = spark.createDataFrame([(t or "-", t) for t in texts], "plain string, marked string")
    artifacts.append_rows(rows.select("plain", text_cell("marked").alias("marked")), path, "plain string, marked string")
    assert sorted(r.plain for r in artifacts.read_rows(spark, path, "plain string, marked string").collect()) == sorted(t or "-" for t in texts)
    back = artifacts.read_rows(spark, path, "plain string, marked string", na_to_null=True, text_cells=True)
    assert sorted(r.marked for r in back.collect()) == sorted(texts)


def test_tree_and_taxonomy(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "sample string, accepted boolean, category string"
    assert artifacts.discover_categories(spark, path, schema) == []
    artifacts.write_tree(spark.createDataFrame([("x", True, "a"), ("y", False, "b")], schema), path)
    artifacts.write_tree(spark.createDataFrame([("z", True, "b")], schema), path)
    assert artifacts.discover_categories(spark, path, schema) == ["a", "b"]
    assert {r["sample"] for r in artifacts.read_tree(spark, path, schema, accepted_only=True).collect()} == {"x", "z"}
    with pytest.raises(ValueError, match="category"):
        artifacts.read_tree(spark, path, schema, ["a/b"])
    artifacts.write_document(spark, artifacts.taxonomy_document("n", {"m": "text", "k": {"description": "d", "subcategories": ["s", "t"]}}), str(tmp_path / "doc"))
    pairs = artifacts.sub_category_pairs(artifacts.read_taxonomy(spark, str(tmp_path / "doc")))
    assert [tuple(r) for r in pairs.collect()] == [("m", "m"), ("k", "s"), ("k", "t")]


def test_model_steps(spark, tmp_path):
    rows = spark.range(40).select(F.col("id").cast("string").alias("k"))
    said = lambda r, model: model_steps.call_model(model_steps.requests_of(r, model, F.array(F.struct(F.lit("user").alias("role"), F.concat("k", "feedback").alias("content")))), model_steps.stub_transport, batch_size=7)
    done = model_steps.checked(rows, lambda r: said(r, "gen"), lambda r: said(r.withColumn("feedback", F.col("text")), "check"), model_steps.saver(str(tmp_path / "s")), attempts=2)
    found = done.collect()
    assert len(found) == 40 and {r.attempt for r in found} == {1, 2}
    assert all(r.accepted or (r.attempt == 2 and r.reasoning.startswith("No")) for r in found)

    def broken(requests):
        raise RuntimeError("prompt too long")

    failed = model_steps.call_model(model_steps.requests_of(rows, "m", F.array(F.struct(F.lit("user").alias("role"), F.col("k").alias("content")))), broken).collect()
    assert {(r.reply, r.error_kind) for r in failed} == {(None, "too_long")}


def test_rate_limit():
    now = [0.0]
    limit = model_steps.RateLimit(2, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    assert [limit.reserve(), limit.reserve()] == [0.0, 0.0]
    assert limit.reserve() == pytest.approx(60.1)
    limit.wait()
    assert now[0] == pytest.approx(60.1)
    assert model_steps.RateLimit(None).reserve() == 0.0


def test_conversations(spark, tmp_path):
    seeds = spark.createDataFrame([("a", "hello"), ("b", "bye")], "input_id string, text string")
    reply = lambda r: r.withColumn("reply", F.concat(F.lit("re "), F.element_at("steps", -1)["content"])).withColumn("error", F.when(F.col("input_id") == "b", "failed"))
    got = {r.input_id: r for r in conversations.converse(seeds, conversations.scripted(["next"]), reply, model_steps.saver(str(tmp_path / "c")), max_turns=2).withColumn("t", conversations.render(F.col("steps"))).withColumn("l", conversations.last_reply(F.col("steps"))).collect()}
    assert got["a"].t == "user: hello\nassistant: re hello\nuser: next\nassistant: re next" and got["a"].stop_reason == "max_turns" and got["a"].l == "re next"
    assert got["b"].stop_reason == "ERROR: failed" and got["b"].steps == []
    bad = spark.createDataFrame([("not json",)], "j string").select(conversations.parse_transcript("j").alias("s")).first()
    assert bad.s == []


def test_beam_search(spark, tmp_path):
    seeds = spark.createDataFrame([(1, ""), (2, "b")], "seed_id int, state string")
    moves = spark.createDataFrame([("a",), ("b",)], "move string")
    score = lambda r: r.withColumn("score", (F.length("state") - F.length(F.replace("state", F.lit("a"), F.lit("")))).cast("double"))
    tree = search.beam_search(seeds, moves, lambda r: r.withColumn("state", F.concat("state", "move")), score, model_steps.saver(str(tmp_path / "b")), beam=2, depth=3, succeeded=F.col("score") >= 3)
    best = {r.seed_id: (r.state, r.score) for r in search.best_nodes(tree).collect()}
    assert best == {1: ("aaa", 3.0), 2: ("baaa", 3.0)}
    assert tree.where("seed_id = 1 AND depth = 3").count() == 4


def test_streams(spark, tmp_path):
    samples = spark.createDataFrame([("x",), ("x",), ("y",)], "sample string")
    samples.write.json(str(tmp_path / "in"))
    stream = jobs.read_events(spark, str(tmp_path / "in"), "sample string")
    q = jobs.first_arrivals(stream).writeStream.format("memory").queryName("arrivals").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("arrivals").count() == 2
    ledger = Ledger(spark, str(tmp_path / "l"), "sample string")
    work = lambda units: (units, units.select("sample", F.lit("done").alias("status")))
    jobs.commit_units(stream, ledger, work, str(tmp_path / "cp")).awaitTermination(60)
    assert ledger.rows("sample string").count() == 3 and ledger.pending(samples).count() == 0


def test_recipe(spark, tmp_path):
    def transport(requests):
        out = []
        for r in requests:
            said = r["messages"][-1]["content"]
            out.append(f"## 1. A\n- (about {said})\n- (more {said})\n[END]" if said.startswith("outline") else model_steps.stub_transport([r])[0])
        return out

    loaded = recipe.Recipe.load({"name": "t", "stages": ["build", "augmentation", "paraphrases", "outputs", "inputs", "constitution"], "models": {"generator": "gen", "checker": "check", "target": "target", "paraphraser": ["p1", "p2"]}, "params": {"augmentation": {"families": ["encode", "casual_writing"], "rounds": 2}}})
    run = recipe.Run(spark, str(tmp_path), loaded, transport, {"cooking": "food", "travel": "trips"})
    counts = recipe.run_recipe(run)
    assert counts["constitution"] == 4 and counts["inputs"] >= 4
    accepted = run.table("inputs").where("accepted").count()
    assert counts["outputs"] == accepted and counts["augmentation"] == 2 * accepted
    assert {r.dataset_type for r in run.table("build").select("dataset_type").distinct().collect()} == {"input", "output", "paraphrase", "augmented"}
    assert artifacts.last_record(spark, f"{tmp_path}/records", "inputs")["counts"] == {"rows": counts["inputs"]}
    for wrong in ({"stages": []}, {"stages": ["nope"]}, {"stages": ["build"], "other": 1}, {"stages": ["build"], "params": {"inputs": {}}}):
        with pytest.raises(ValueError):
            recipe.Recipe.load(wrong)


def test_paraphrases_are_checked_and_drops_acknowledged(spark, tmp_path):
    def transport(requests):
        out = []
        for r in requests:
            kind, _, said = r["messages"][-1]["content"].partition(": ")
            if kind == "check":
                out.append("no, another meaning" if "bad text" in said else "yes")
            else:
                out.append({"same": "same", "void": " ", "dup1": "one text", "dup2": "one text", "bad": "bad text"}.get(said, said + " again"))
        return out

    def broken(requests):
        raise ConnectionError("down")

    texts = ["same", "void", "dup1", "dup2", "bad", "plain"]
    inputs = [(t, t, "c", "e", True) for t in texts] + [("left out", "left out", "c", "e", False)]
    spark.createDataFrame(inputs, "sample_id string, sample string, category string, entry_type string, accepted boolean").write.parquet(f"{tmp_path}/inputs")
    outputs = [("o", "plain", "c", "e", True), ("o", "plain", "c", "f", True)]
    spark.createDataFrame(outputs, "sample_id string, output_response string, category string, entry_type string, accepted boolean").write.parquet(f"{tmp_path}/outputs")
    loaded = recipe.Recipe.load({"stages": ["paraphrases"], "models": {"checker": "check", "paraphraser": ["p1", "p2"]}, "params": {"paraphrases": {"target": "both"}}})
    down = recipe.Run(spark, str(tmp_path), loaded, broken)
    assert recipe.run_recipe(down) == {"paraphrases": 0}
    acks = Ledger(spark, f"{tmp_path}/ledger/paraphrases", "source string, input_id string, iteration int").acks
    assert acks().isEmpty()
    run = recipe.Run(spark, str(tmp_path), loaded, transport)
    recipe.run_recipe(run)
    found = {(r.input_id, r.sample, r.accepted) for r in run.table("paraphrases").collect()}
    # dup1 comes before dup2, and the input "plain" before the output of the same rewording
    assert found == {("dup1", "one text", True), ("bad", "bad text", False), ("plain", "plain again", True)}
    assert {(r.source, r.input_id, r.status) for r in acks().collect()} == {
        *[("inputs", t, "done") for t in ("dup1", "bad", "plain")], *[("inputs", t, "dropped_dedup") for t in ("same", "void", "dup2")], ("outputs", "o", "dropped_dedup"),
    }
    # nothing is asked again
    assert recipe.run_recipe(down) == {"paraphrases": 3}
    with pytest.raises(ValueError):
        recipe._originals(run, "elsewhere")


def test_standalone_inputs(spark, tmp_path):

    def transport(requests):
        out = []
        for r in requests:
            said = r["messages"][-1]["content"]
            if said.startswith("check: "):
                out.append("No: dull" if said.endswith("one") else "Yes.")
            elif "same" in said:
                out.append("1. one\n2. two")
            else:
                out.append("no list" if "mute" in said else f"1. one\n2. known {said.count('known')}{' told' if 'dull' in said else ''}")
        return out

    params = {"inputs": {"standalone": True, "samples_per_category": 3, "samples_per_request": 2, "seeds": {"same": ["s"], "mute": ["s"], "more": ["s"], "unseeded": []}}}
    loaded = recipe.Recipe.load({"stages": ["inputs"], "models": {"generator": "gen", "checker": "check"}, "params": params})
    run = recipe.Run(spark, str(tmp_path), loaded, transport, {k: "" for k in ("same", "mute", "more", "unseeded", "without")})
    recipe.run_recipe(run)
    rows = {(r.category, r.sample, r.turn, r.accepted, r.rejection_reason) for r in run.table("inputs").collect()}
    # "one" of both categories is one text, kept where it came first; "same" stops at the turn that brings nothing new
    assert rows == {("more", "one", 0, False, "No: dull"), ("more", "known 0", 0, True, ""), ("same", "two", 0, True, ""), ("more", "known 1 told", 1, True, ""), ("more", "known 2", 2, True, "")}


def test_generation_bounds(spark, tmp_path):
    rows = spark.createDataFrame([("a",)], "category string")
    call = lambda **k: generation.until_target(rows, None, None, None, model_steps.saver(str(tmp_path)), **k)
    assert call(target=0, per_request=2).isEmpty()
    for wrong in ({"target": -1, "per_request": 1}, {"target": 1, "per_request": 0}):
        with pytest.raises(ValueError):
            call(**wrong)


def test_inputs_trace_and_counts(spark, tmp_path):
    schema = "sample string, accepted boolean, category string"
    samples = spark.createDataFrame([("x", True, "a"), ("y", False, "a")], schema)
    read = lambda: [r.sample for r in artifacts.read_inputs(spark, str(tmp_path / "s"), str(tmp_path / "p"), schema).collect()]
    assert read() == []
    artifacts.write_tree(samples, str(tmp_path / "p"))
    assert read() == ["x"]
    artifacts.write_tree(samples.withColumn("sample", F.lit("z")), str(tmp_path / "s"))
    assert read() == ["z"]
    rows = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [tuple(r) for r in relational.most_common(rows, "k", 2).collect()] == [("c", 2), ("a", 1)]
    events = spark.createDataFrame([("call", 1.5, None)], "ev string, ms double, model string")
    for _ in range(2):
        telemetry.append_events(events, str(tmp_path / "t"))
    assert [(r.ev, r.ms, r.model, r.cut) for r in telemetry.read_trace(spark, str(tmp_path / "t")).collect()] == [("call", 1.5, None, None)] * 2
    taxonomy = spark.createDataFrame([(1, "b"), (0, "a")], "pos int, category string")
    assert [r.category for r in artifacts.first_categories(taxonomy, 1).collect()] == ["a"]
    assert artifacts.first_categories(taxonomy, None).count() == 2
