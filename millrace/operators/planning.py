"""The plan of an augmentation: which combination of techniques each unit gets.

Dealing is in closed form. A unit has a place in its part of the group (category, entry_type); a layer of rate r is due at
place p when floor(r * p + offset) steps up, so any run of places gets its share, and families take turns by place. No
unit needs what another one drew, so a plan is a map over rows once the places are known, and a large group is split into
parts by a hash of the sample id, each part dealt evenly.

What may still join a combination is a bit mask over the pool: a pick clears what it excludes and, at its layer's cap, the
rest of its layer.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.keys import seed_of
from millrace.functions.techniques import LAYER_CAPS, LAYER_RATES, LAYERS, Technique, compatible

PLAN = "sample_id string, iteration int, combination array<string>, category string, entry_type string, status string"
MAX_DRAWS = 8
#: Units of a group that are dealt together.
PART_UNITS = 50_000
#: The four rounds of the built-in escalation.
ESCALATION = (
    {"exact": 1},
    {"exact": 2},
    {"max_complexity": 6, "max_obfuscations": 2, "rates": {"hacking": 0.7, "manipulation": 0.5, "requests": 0.8, "request_obfuscation": 0.5}, "request_obfuscation": True},
    {"max_complexity": 9, "max_obfuscations": 3, "rates": {"hacking": 0.9, "manipulation": 0.7, "requests": 0.9, "request_obfuscation": 0.7}, "request_obfuscation": True},
)


def bits(mask: int) -> Iterator[int]:
    while mask:
        yield (mask & -mask).bit_length() - 1
        mask &= mask - 1


class Pool:
    """The techniques of a plan as bit masks; technique k is bit k."""

    def __init__(self, techniques: list[Technique], weights: dict[str, float] | None = None):
        self.techniques = techniques
        mask = lambda test: sum(1 << k for k, t in enumerate(techniques) if test(t))
        self.layer = {layer: mask(lambda t, x=layer: t.layer == x) for layer in LAYERS}
        self.within = [mask(lambda t, c=cost: t.complexity <= c) for cost in range(1 + max((t.complexity for t in techniques), default=0))]
        self.friends = [mask(lambda t, x=one: t is not x and compatible(t, x)) for one in techniques]
        self.late = mask(lambda t: "translation" in t.families or t.encode_weight == "light")
        families = sorted({t.families[0] for t in techniques})
        # a family of weight w has w times the turns of one of weight 1, spread over the cycle
        turns = {f: max(1, round(4 * (weights or {}).get(f, 1.0))) for f in families}
        self.cycle = [f for _, f in sorted(((k + 0.5) / n, f) for f, n in turns.items() for k in range(n))]
        self.family = {f: mask(lambda t, x=f: t.families[0] == x) for f in families}

    def affordable(self, budget: int | None) -> int:
        return (1 << len(self.techniques)) - 1 if budget is None else 0 if budget < 0 else self.within[min(budget, len(self.within) - 1)]


class Combination:
    """Picks of a unit so far."""

    def __init__(self, pool: Pool, allowed: int, rng: random.Random, turn: int, budget: int | None = None):
        self.pool, self.open, self.rng, self.turn, self.budget = pool, allowed, rng, turn, budget
        self.picks: list[int] = []

    def take(self, among: int = -1) -> bool:
        """One more of `among`, if any may join: of the next family in the cycle that has one, a random one."""
        choice = self.open & among & self.pool.affordable(self.budget)
        if not choice:
            return False
        cycle = self.pool.cycle
        at = next(k for k in range(self.turn, self.turn + len(cycle)) if self.pool.family[cycle[k % len(cycle)]] & choice)
        picked = self.rng.choice([*bits(self.pool.family[cycle[at % len(cycle)]] & choice)])
        self.turn = at + 1
        technique = self.pool.techniques[picked]
        self.picks.append(picked)
        self.open &= self.pool.friends[picked]
        if sum(self.pool.techniques[k].layer == technique.layer for k in self.picks) >= LAYER_CAPS.get(technique.layer, math.inf):
            self.open &= ~self.pool.layer[technique.layer]
        if self.budget is not None:
            self.budget -= technique.complexity
        return True

    def names(self) -> list[str]:
        return [t.name for t in sorted((self.pool.techniques[k] for k in self.picks), key=lambda t: t.rank)]


def due(place: int, rate: float, offset: float) -> bool:
    return math.floor(rate * place + offset) > math.floor(rate * (place - 1) + offset)


def offset_of(*parts: object) -> float:
    """A part's offset for a layer, from its key: 0 to 1."""
    return (seed_of(*parts) >> 12) / (1 << 52)


def draw(pool: Pool, settings: dict, rng: random.Random, *, turn: int, layers: dict[str, bool]) -> list[str]:
    """A combination in the order it applies: of exactly settings["exact"] techniques, or, within a budget of complexity,
    a pick of each layer that is due and up to max_obfuscations of that layer; where `request_obfuscation` is due, one
    more light one follows the finished request. layers tells what is due."""
    allowed = sum(pool.layer[layer] for layer in LAYERS if settings.get(f"include_{layer}", True))
    if settings.get("exact") is not None:
        made = Combination(pool, allowed, rng, turn)
        while len(made.picks) < settings["exact"] and made.take():
            pass
        return made.names()
    made = Combination(pool, allowed, rng, turn, settings.get("max_complexity", 6))
    for layer, most in (("hacking", 1), ("manipulation", 1), ("obfuscation", settings.get("max_obfuscations", 2)), ("requests", 1)):
        for _ in range(most if layers.get(layer, True) else 0):
            if not made.take(pool.layer[layer]):
                break
    names = made.names()
    if layers.get("request_obfuscation") and made.take(pool.late):
        names.append(pool.techniques[made.picks[-1]].name)
    return names


def deal(pool: Pool, rounds: tuple[dict, ...], seed: int, sample_id: str, group: tuple[str, str, int], place: int) -> list[list[str]]:
    """The unit's combination in each round; one that the sample has had is drawn again, as often as MAX_DRAWS."""
    had: list[list[str]] = []
    for iteration, settings in enumerate(rounds):
        rates = LAYER_RATES | settings.get("rates", {})
        layers = {layer: due(place, rate, offset(seed, *group, iteration, layer)) for layer, rate in rates.items() if layer != "request_obfuscation" or settings.get("request_obfuscation")}
        base, turn = seed_of(seed, sample_id, iteration), place + int(offset(seed, *group, iteration, "turn") * len(pool.cycle))
        names: list[str] = []
        for attempt in range(MAX_DRAWS):
            names = draw(pool, settings, random.Random(base + attempt), turn=turn + attempt, layers=layers)
            if names not in had:
                break
        had.append(names)
    return had


offset = lru_cache(maxsize=1 << 16)(offset_of)


def plan(inputs: DataFrame, pool: list[Technique], *, seed: int = 42, rounds: tuple[dict, ...] = ({},), weights: dict[str, float] | None = None, part_units: int = PART_UNITS) -> DataFrame:
    """A row per input and round. inputs has sample_id, category and entry_type; null cells of the taxonomy are ''; rows
    without a sample_id go, and rows that repeat one are one unit. A group of more than part_units units is dealt in parts."""
    cells = inputs.where("sample_id IS NOT NULL").select("sample_id", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("category", "entry_type")])
    units = cells.groupBy("sample_id").agg(F.min(F.struct("category", "entry_type")).alias("g")).select("sample_id", "g.*")
    sizes = units.groupBy("category", "entry_type").agg(F.ceil(F.count(F.lit(1)) / part_units).cast("int").alias("parts"))
    parted = units.join(sizes, ["category", "entry_type"]).withColumn("part", F.pmod(F.xxhash64("sample_id"), F.col("parts")).cast("int"))
    placed = parted.withColumn("place", F.row_number().over(Window.partitionBy("category", "entry_type", "part").orderBy("sample_id")))

    @F.pandas_udf("array<array<string>>")
    def dealt(sample: pd.Series, category: pd.Series, entry_type: pd.Series, part: pd.Series, place: pd.Series) -> pd.Series:
        masks = Pool(pool, weights)
        return pd.Series([deal(masks, rounds, seed, s, (c, e, p), n) for s, c, e, p, n in zip(sample, category, entry_type, part, place)], dtype=object)

    made = placed.select("sample_id", "category", "entry_type", F.posexplode(dealt("sample_id", "category", "entry_type", "part", "place")).alias("iteration", "combination"))
    return made.select("sample_id", "iteration", "combination", "category", "entry_type", F.lit("planned").alias("status"))


def short_layers(planned: DataFrame, registry: DataFrame, rates: dict[str, float] | None = None, short: int = 2) -> DataFrame:
    """Groups whose picks of a layer fell `short` or more below its rate times the group's size."""
    groups = ("category", "entry_type", "iteration")
    sizes = planned.groupBy(*groups).agg(F.count(F.lit(1)).alias("units"))
    goal = F.explode(F.create_map(*[F.lit(x) for pair in (rates or {k: v for k, v in LAYER_RATES.items() if k != "request_obfuscation"}).items() for x in pair])).alias("layer", "rate")
    picks = planned.select(*groups, F.explode("combination").alias("technique")).join(registry.select("technique", "layer"), "technique").groupBy(*groups, "layer").agg(F.count(F.lit(1)).alias("n"))
    # as decimals: 0.7 of 90 units is 63, in doubles 62.99…
    due_picks = F.col("rate").cast("decimal(18,16)") * F.col("units").cast("decimal(19,0)")
    targets = sizes.select(*groups, "units", goal).withColumn("target", F.floor(due_picks).cast("bigint"))
    return targets.join(picks, [*groups, "layer"], "left").withColumn("n", F.coalesce("n", F.lit(0))).where(F.col("target") - F.col("n") >= short)
