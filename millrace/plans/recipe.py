"""Recipes: validated configurations that run the stages of a dataset build in order."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import parsing, text
from millrace.functions.keys import content_id, hash_bucket
from millrace.functions.techniques import Technique, registry_frame, technique_pool
from millrace.functions.transforms import run_chains
from millrace.operators import generation, model_steps, planning, relational
from millrace.operators.ledger import Ledger
from millrace.sources import artifacts

#: Stages in the order they run.
STAGE_ORDER = ("constitution", "inputs", "outputs", "paraphrases", "augmentation", "build")
#: Augmentation settings and their defaults.
AUGMENTATION = {"rounds": 1, "families": None, "techniques": [], "without_families": [], "without": [], "max_complexity": 6, "max_obfuscations": 2, "pure_only": True, "seed": 42, "family_weights": None}


def load_params(given: str | dict | None) -> dict:
    """A stage's params as a dict or JSON text; none is an empty dict."""
    found = json.loads(given) if isinstance(given, str) else dict(given or {})
    if not isinstance(found, dict):
        raise ValueError("params must be an object")
    return found


def resolve_augmentation(given: dict | None) -> dict:
    """The settings over the defaults; unknown names and values out of range are refused."""
    if unknown := set(given or {}) - set(AUGMENTATION):
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    out = AUGMENTATION | (given or {})
    if out["rounds"] != "escalation" and not (isinstance(out["rounds"], int) and out["rounds"] >= 1):
        raise ValueError("rounds must be at least 1, or 'escalation'")
    return out


def rounds_of(settings: dict) -> tuple[dict, ...]:
    base = {k: settings[k] for k in ("max_complexity", "max_obfuscations")}
    if settings["rounds"] == "escalation":
        return tuple(base | r for r in planning.ESCALATION)
    return (base,) * settings["rounds"]


@dataclass
class Recipe:
    """Which stages run, with which parameters and models."""

    name: str
    stages: list[str]
    params: dict[str, dict] = field(default_factory=dict)
    models: dict[str, list[str]] = field(default_factory=dict)

    @classmethod
    def load(cls, source: str | dict) -> Recipe:
        """From a dict or JSON text. Stages must be known and named once; keys must be known."""
        given = json.loads(source) if isinstance(source, str) else dict(source)
        if unknown := set(given) - {"name", "stages", "params", "models"}:
            raise ValueError(f"unknown keys: {', '.join(sorted(unknown))}")
        stages = given.get("stages", [])
        if unknown := set(stages) - set(STAGE_ORDER):
            raise ValueError(f"unknown stages: {', '.join(sorted(unknown))}")
        if len(set(stages)) != len(stages) or not stages:
            raise ValueError("stages must be named, each once")
        if unknown := set(given.get("params", {})) - set(stages):
            raise ValueError(f"params of stages that don't run: {', '.join(sorted(unknown))}")
        recipe = cls(given.get("name", "run"), sorted(stages, key=STAGE_ORDER.index), {k: load_params(v) for k, v in given.get("params", {}).items()}, {k: [v] if isinstance(v, str) else list(v) for k, v in given.get("models", {}).items()})
        if "augmentation" in stages:
            resolve_augmentation(recipe.params.get("augmentation"))
        return recipe

    def role(self, role: str) -> list[str]:
        if role not in self.models:
            raise ValueError(f"no model for the role {role}")
        return self.models[role]


@dataclass
class Run:
    """What stages share: the session, the run's folder, the recipe and the transport of model calls."""

    spark: SparkSession
    folder: str
    recipe: Recipe
    transport: model_steps.Transport = model_steps.stub_transport
    categories: dict[str, str] = field(default_factory=dict)
    timestamp: str = "1970-01-01T00:00:00Z"

    def save(self, stage: str) -> Callable[[DataFrame, str], DataFrame]:
        return model_steps.saver(f"{self.folder}/steps/{stage}")

    def ask(self, rows: DataFrame, model: Any, said: Any) -> DataFrame:
        message = F.array(F.struct(F.lit("user").alias("role"), said.alias("content")))
        return model_steps.call_model(model_steps.requests_of(rows, model, message), self.transport).drop("model", "messages", "max_tokens")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")


def constitution(run: Run, params: dict) -> DataFrame:
    """Categories x entry types: a reply in outline form each, complete ones parsed into descriptions."""
    rows = run.spark.createDataFrame([(c, d, e) for c, d in run.categories.items() for e in params.get("entry_types", text.ENTRY_TYPES[-1:])], "category string, about string, entry_type string")
    replies = run.save("constitution")(run.ask(rows, run.recipe.role("generator")[0], F.concat_ws(" ", F.lit("outline"), "entry_type", "category", "about")), "replies")
    found = parsing.outline_rows(replies.where("error IS NULL").select(F.col("category").alias("source_category"), "entry_type", "reply"))
    return found.select(content_id("sample").alias("sample_id"), F.col("category").alias("constitution_category"), F.col("subcategory").alias("constitution_subcategory"), F.col("sample").alias("sample_description"), "entry_type", "source_category")


def inputs(run: Run, params: dict) -> DataFrame:
    """Per description a checked sample list: generated until it parses, the first of each text kept, then judged.
    With `standalone` the categories themselves are asked for, without descriptions."""
    if params.get("standalone"):
        return standalone(run, params)
    plan = run.table("constitution").select("sample_description", "entry_type", F.col("source_category").alias("category"))
    model = run.recipe.role("generator")[0]
    made = model_steps.extracted(plan, lambda r: run.ask(r, model, F.concat(F.lit("samples of: "), F.col("sample_description"))), lambda c: parsing.samples(c, params.get("samples_per_request")), run.save("inputs"), attempts=params.get("attempts", 3))
    samples = made.select("category", "entry_type", "sample_description", F.posexplode("items").alias("pos", "sample")).withColumn("sample_id", content_id("sample"))
    unique = relational.first_wins(samples.withColumn("_o", F.concat_ws("|", "category", "entry_type", "sample_description", F.lpad(F.col("pos").cast("string"), 6, "0"))), "sample_id", "_o").drop("_o", "pos")
    judged = run.save("inputs")(run.ask(unique, run.recipe.role("checker")[0], F.concat(F.lit("check: "), F.col("sample"))), "judged")
    return judged.where("error IS NULL").withColumn("v", text.verdict("reply")).select("sample_id", "sample", "category", "entry_type", F.lit(0).alias("turn"), F.col("v.accepted").alias("accepted"), F.col("v.reasoning").alias("rejection_reason"), F.lit("generated").alias("source"))


def standalone(run: Run, params: dict) -> DataFrame:
    """Samples of each of the run's categories, in turns until enough are accepted (see generation.until_target). Seeds
    are the user's (`seeds`, lists by category) or asked for; a category without any is left out."""
    model, checker, given = run.recipe.role("generator")[0], run.recipe.role("checker")[0], params.get("seeds")
    per_request = params.get("samples_per_request", 5)
    save = run.save("standalone")
    rows = run.spark.createDataFrame(list(run.categories.items()), "category string, about string")
    if given is None:
        asked = run.ask(rows, model, F.concat_ws("\n", F.concat(F.lit("seeds of: "), F.col("category")), "about"))
        listed = save(asked.select("category", "about", parsing.samples("reply").alias("seeds")), "seeds")
    else:
        seeds = run.spark.createDataFrame(list(given.items()), "category string, seeds array<string>")
        listed = rows.join(seeds, "category")
    seeded = listed.where(F.size("seeds") > 0).withColumn("seeds", text.ordinal_list("seeds"))
    said = F.concat_ws("\n", F.concat(F.lit(f"{per_request} samples of: "), F.col("category")), *[F.when(F.col(c) != "", F.col(c)) for c in ("about", "seeds", "prohibited", "feedback")])
    made = generation.until_target(
        seeded,
        lambda r: run.ask(r, model, said),
        lambda reply: parsing.samples(reply, per_request),
        lambda r: run.ask(r, checker, F.concat(F.lit("check: "), F.col("sample"))),
        save,
        target=params.get("samples_per_category", 15),
        per_request=per_request,
    )
    ordered = made.withColumn("sample_id", content_id("sample")).withColumn("_o", F.struct("turn", "pos", "category"))
    unique = relational.first_wins(ordered, "sample_id", "_o")
    return unique.select("sample_id", "sample", "category", F.lit(params.get("entry_type", text.ENTRY_TYPES[-1])).alias("entry_type"), "turn", "accepted", F.col("reasoning").alias("rejection_reason"), F.lit("metaprompt").alias("source"))


def outputs(run: Run, params: dict) -> DataFrame:
    """A checked response to each accepted input, groups capped; the last attempt is kept even if rejected."""
    rows = run.table("inputs").where("accepted").select(F.col("sample_id").alias("input_id"), F.col("sample").alias("input_prompt"), "category", "entry_type")
    capped = relational.take_per_group(rows, params.get("per_group"), "input_id")
    target, checker = run.recipe.role("target")[0], run.recipe.role("checker")[0]
    done = model_steps.checked(
        capped,
        lambda r: run.ask(r, target, F.concat(F.col("input_prompt"), F.when(F.col("feedback") != "", F.concat(F.lit("\n"), F.col("feedback"))).otherwise(""))),
        lambda r: run.ask(r, checker, F.concat(F.lit("check: "), F.col("text"))),
        run.save("outputs"),
        attempts=params.get("attempts", 3),
    )
    return done.select("input_id", "input_prompt", "category", "entry_type", F.lit(target).alias("model"), content_id("text").alias("sample_id"), F.col("text").alias("output_response"), "accepted", F.coalesce("reasoning", "error").alias("rejection_reason"))


PARAPHRASES = "sample_id string, input_id string, iteration int, sample string, category string, entry_type string, paraphrase_model string, accepted boolean, reasoning string, source string"


def _originals(run: Run, target: str) -> DataFrame:
    """The accepted texts of a target: inputs, outputs or both. Outputs of equal text are one unit."""
    columns = {"inputs": "sample", "outputs": "output_response"}
    if target != "both" and target not in columns:
        raise ValueError(f"nothing to paraphrase: {target}")
    parts = [
        run.table(name).where("accepted").select(F.lit(name).alias("source"), F.col("sample_id").alias("input_id"), F.col(column).alias("original"), "category", "entry_type")
        for name, column in columns.items()
        if target in (name, "both")
    ]
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    ordered = rows.withColumn("_k", F.concat_ws("|", "source", "input_id")).withColumn("_o", F.concat_ws("|", "category", "entry_type"))
    return relational.first_wins(ordered, "_k", "_o").drop("_k", "_o")


def paraphrases(run: Run, params: dict) -> DataFrame:
    """k rewordings of each accepted text, each by a model that a hash picks of the pool, then checked against it.

    A rejected rewording stays as such. Empty ones, those equal to their original and repeats of any rewording are
    dropped, but acknowledged as dropped_dedup, so that they aren't asked for again. A unit whose call failed has no
    acknowledgement and is asked again by the next run."""
    pool, checker, k = run.recipe.role("paraphraser"), run.recipe.role("checker")[0], params.get("k", 1)
    keys = ["source", "input_id", "iteration"]
    ledger = Ledger(run.spark, f"{run.folder}/ledger/paraphrases", "source string, input_id string, iteration int")
    number, save = ledger.next_save(), run.save("paraphrases")
    units = ledger.pending(relational.with_iterations(_originals(run, params.get("target", "inputs")), k))
    bucket = hash_bucket(len(pool), F.lit(str(params.get("seed", 42))), F.col("input_id"), F.col("iteration").cast("string"))
    asked = units.withColumn("paraphrase_model", F.element_at(F.array(*map(F.lit, pool)), bucket + 1))
    told = save(run.ask(asked, F.col("paraphrase_model"), F.concat(F.lit("reword: "), F.col("original"))), f"replies-{number}").where("error IS NULL")
    made = told.drop("error", "error_kind").withColumn("sample", text.clean_sample("reply")).withColumn("sample_id", content_id("sample")).drop("reply")
    new = made.where("trim(sample) <> '' AND sample <> original").join(ledger.rows(PARAPHRASES).select("sample_id"), "sample_id", "left_anti")
    unique = relational.first_wins(new.withColumn("_o", F.concat_ws("|", "source", "input_id", F.lpad(F.col("iteration").cast("string"), 6, "0"))), "sample_id", "_o").drop("_o")
    tested = save(run.ask(unique, checker, F.concat(F.lit("check: "), F.col("original"), F.lit("\n"), F.col("sample"))), f"checked-{number}")
    rows = tested.where("error IS NULL").withColumn("v", text.verdict("reply")).select("sample_id", "input_id", "iteration", "sample", "category", "entry_type", "paraphrase_model", F.col("v.accepted").alias("accepted"), F.col("v.reasoning").alias("reasoning"), "source")
    dropped = told.join(tested.select(*keys), keys, "left_anti")
    ledger.commit(rows, rows.select(*keys, F.lit("done").alias("status")).unionAll(dropped.select(*keys, F.lit("dropped_dedup").alias("status"))))
    return ledger.rows(PARAPHRASES)


def augmentation(run: Run, params: dict) -> DataFrame:
    """The plan, written once and reused, and its chains over the inputs; what is done is acknowledged and not repeated."""
    settings = resolve_augmentation(params)
    pool = _pool(settings)
    source = run.table("inputs").where("accepted")
    planned = run.save("augmentation")(planning.plan(source, pool, seed=settings["seed"], rounds=rounds_of(settings), weights=settings["family_weights"]), "plan")
    ledger = Ledger(run.spark, f"{run.folder}/ledger/augmentation")
    registry = registry_frame(run.spark, pool)
    units = relational.pending(planned, source, ledger.acks()).join(source.select("sample_id", F.col("sample").alias("text")), "sample_id")
    ran = run_chains(units.withColumn("seed", F.lit(settings["seed"])))
    costs = F.map_from_entries(F.array(*[F.struct(F.lit(t.name), F.lit(t.complexity)) for t in pool]))
    rejected = F.col("info").startswith("DISCARDED")
    rows = ran.select(
        content_id("result").alias("sample_id"), F.col("sample_id").alias("input_id"), "iteration", F.col("text").alias("sample"), F.col("result").alias("jailbreak"), "category", "entry_type",
        F.array_join("combination", "+").alias("technique"), F.col("info").alias("technique_info"), F.aggregate(F.transform("combination", lambda n: F.element_at(costs, n)), F.lit(0), lambda a, b: a + b).alias("complexity"),
        F.size("combination").alias("num_techniques"), (F.col("text") == F.col("result")).alias("is_noop"), (~rejected).alias("accepted"), F.when(rejected, F.col("info")).otherwise("").alias("reasoning"),
    )
    saved = run.save("augmentation")(rows, f"rows-{ledger.next_save()}")
    ledger.commit(saved, saved.select(F.col("input_id").alias("sample_id"), "iteration", F.lit("done").alias("status")))
    relational.coverage(planned, registry).write.mode("overwrite").parquet(f"{run.folder}/coverage")
    return ledger.rows(", ".join(f"{n} {t}" for n, t in saved.dtypes))


def _pool(settings: dict) -> list[Technique]:
    families = tuple(settings["families"]) if settings["families"] is not None else None
    found = technique_pool(families=families, names=tuple(settings["techniques"]), without_families=tuple(settings["without_families"]), without=tuple(settings["without"]), pure_only=settings["pure_only"])
    return [t for t in found if t.kind in "ER"] if settings["pure_only"] else found


def build(run: Run, params: dict) -> DataFrame:
    """The accepted rows of all parts, tagged, by column name."""
    parts = []
    for name, kind in (("inputs", "input"), ("outputs", "output"), ("paraphrases", "paraphrase"), ("augmentation", "augmented")):
        if name in run.recipe.stages or name in params.get("parts", ()):
            parts.append(relational.Part(run.table(name).withColumn("accepted", F.col("accepted").cast("string")), kind, True))
    if not parts:
        raise ValueError("nothing to build from")
    return relational.union_parts(parts)


STAGES: dict[str, Callable[[Run, dict], DataFrame]] = {"constitution": constitution, "inputs": inputs, "outputs": outputs, "paraphrases": paraphrases, "augmentation": augmentation, "build": build}


def run_recipe(run: Run) -> dict[str, int]:
    """Runs the recipe's stages, each into a table of its name, with a record of its counts; returns the counts."""
    counts = {}
    for stage in run.recipe.stages:
        params = run.recipe.params.get(stage, {})
        run.spark.sparkContext.setJobDescription(f"{run.recipe.name}: {stage}")
        STAGES[stage](run, params).write.mode("overwrite").parquet(f"{run.folder}/{stage}")
        counts[stage] = run.table(stage).count()
        artifacts.append_record(run.spark, f"{run.folder}/records", stage=stage, timestamp=run.timestamp, params=params, models=run.recipe.models, counts={"rows": counts[stage]})
    run.spark.sparkContext.setJobDescription(None)
    return counts
