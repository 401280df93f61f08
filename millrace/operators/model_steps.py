"""Model calls as stages of a dataflow: requests in, replies out, each step written before the next one reads it.

A transport is a picklable function from requests to replies, called with batches inside tasks. A step is never computed
twice: its replies are written first, so a retried task of a later step finds them.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import MESSAGE, verdict

Transport = Callable[[list[dict]], list[str]]


def stub_transport(requests: list[dict]) -> list[str]:
    """Deterministic replies for tests: a checker's request is accepted by a hash of its last message, any other gets a
    numbered list that quotes it."""
    out = []
    for r in requests:
        said = r["messages"][-1]["content"] if r["messages"] else ""
        digest = hashlib.md5(said.encode()).hexdigest()
        if r["model"].startswith("check"):
            out.append("Yes." if int(digest[0], 16) < 12 else f"No: {digest[:6]}")
        else:
            out.append(f"1. {said[:40]} {digest[:4]}\n2. {said[:40]} {digest[4:8]}")
    return out


class RateLimit:
    """At most `rpm` reservations in any 60 seconds of a task; a task gets its share of the whole budget."""

    def __init__(self, rpm: int | None, *, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rpm, self.clock, self.sleep, self.taken = rpm, clock, sleep, deque()

    def reserve(self) -> float:
        """0 when the call may go and is counted, else the seconds to wait."""
        if self.rpm is None:
            return 0.0
        now = self.clock()
        while self.taken and now - self.taken[0] >= 60:
            self.taken.popleft()
        if len(self.taken) < self.rpm:
            self.taken.append(now)
            return 0.0
        return 60 - (now - self.taken[0]) + 0.1

    def wait(self) -> None:
        while (pause := self.reserve()) > 0:
            self.sleep(pause)


def call_model(requests: DataFrame, transport: Transport, *, batch_size: int = 32, lanes: int = 4, rpm_per_task: int | None = None) -> DataFrame:
    """Adds `reply` and `error` to requests (model, messages, max_tokens and any other columns).

    Rows of a model are brought together, calls go out in batches of batch_size over `lanes` threads, in order. A call
    that raises gives its rows an error and no reply; error_kind tells a prompt that was too long.
    """
    requests = requests.drop("reply", "error", "error_kind")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema) + ", reply string, error string, error_kind string"

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limit = RateLimit(rpm_per_task)

        def one(batch: pd.DataFrame) -> list[tuple]:
            limit.wait()
            asked = [{"model": m, "messages": [{"role": x["role"], "content": x["content"]} for x in ms], "max_tokens": t} for m, ms, t in zip(batch["model"], batch["messages"], batch["max_tokens"])]
            try:
                return [(reply, None, None) for reply in transport(asked)]
            except Exception as why:  # noqa: BLE001  a failed call is a row's error, not the job's
                return [(None, f"{type(why).__name__}: {why}", "too_long" if "too long" in str(why) else "failed")] * len(batch)

        with ThreadPoolExecutor(lanes) as pool:
            for frame in frames:
                batches = [part.iloc[k : k + batch_size] for _, part in frame.groupby(["model", frame["max_tokens"].fillna(-1)], sort=False) for k in range(0, len(part), batch_size)]
                for batch, found in zip(batches, pool.map(one, batches)):
                    yield batch.assign(**{name: [row[k] for row in found] for k, name in enumerate(("reply", "error", "error_kind"))})

    return requests.mapInPandas(run, schema)


def requests_of(rows: DataFrame, model: Column | str, messages: Column, max_tokens: int | None = None) -> DataFrame:
    return rows.withColumn("model", F.lit(model) if isinstance(model, str) else model).withColumn("messages", messages.cast(f"array<{MESSAGE}>")).withColumn("max_tokens", F.lit(max_tokens).cast("int"))


def checked(rows: DataFrame, generate: Callable[[DataFrame], DataFrame], check: Callable[[DataFrame], DataFrame], save: Callable[[DataFrame, str], DataFrame], *, attempts: int = 3) -> DataFrame:
    """Generate, check, and generate again with the checker's reasons what was rejected, up to `attempts` times.

    generate and check add a reply; rows come with `feedback` (empty at first). The result has text, accepted,
    reasoning, attempt and error; a unit that is never accepted keeps its last text. save writes a step and reads it.
    """
    open_, done = rows.withColumn("feedback", F.lit("")), None
    keep = rows.columns
    for attempt in range(1, attempts + 1):
        made = save(generate(open_).withColumnRenamed("reply", "text").select(*keep, "text", "error", "error_kind"), f"generated-{attempt}")
        tested = save(check(made.where("error IS NULL").select(*keep, "text")).select(*keep, "text", "reply"), f"checked-{attempt}")
        judged = tested.withColumn("v", verdict("reply")).select(*keep, "text", F.col("v.accepted").alias("accepted"), F.col("v.reasoning").alias("reasoning"), F.lit(None).cast("string").alias("error"))
        failed = made.where("error IS NOT NULL").select(*keep, F.lit("").alias("text"), F.lit(False).alias("accepted"), F.lit("").alias("reasoning"), "error")
        ended = judged if attempt == attempts else judged.where("accepted")
        ended = ended.unionByName(failed).withColumn("attempt", F.lit(attempt))
        done = ended if done is None else done.unionByName(ended)
        if attempt == attempts:
            break
        open_ = judged.where("NOT accepted").select(*keep, F.col("reasoning").alias("feedback"))
        if open_.isEmpty():
            break
    return done


def extracted(rows: DataFrame, generate: Callable[[DataFrame], DataFrame], parse: Callable[[str], Column], save: Callable[[DataFrame, str], DataFrame], *, attempts: int = 3) -> DataFrame:
    """Generate until the parser finds items: rows with `items` (maybe none after the last attempt) and `attempt`."""
    open_, done = rows, None
    for attempt in range(1, attempts + 1):
        made = save(generate(open_).withColumn("items", parse("reply")).withColumn("attempt", F.lit(attempt)).select(*rows.columns, "items", "attempt"), f"extracted-{attempt}")
        ended = made if attempt == attempts else made.where(F.size("items") > 0)
        done = ended if done is None else done.unionByName(ended)
        open_ = made.where(F.size("items") <= 0).select(*rows.columns)
        if attempt == attempts or open_.isEmpty():
            break
    return done


def saver(folder: str) -> Callable[[DataFrame, str], DataFrame]:
    """A save for the loops above: a Parquet table per step below `folder`. A step that a former run has finished is
    read and not computed again."""

    def save(df: DataFrame, step: str) -> DataFrame:
        spark, where = df.sparkSession, f"{folder.rstrip('/')}/{step}"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{where}/_SUCCESS")
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            df.write.mode("overwrite").parquet(where)
        return spark.read.schema(df.schema).parquet(where)

    return save


def transcript_json(steps: list[dict]) -> str:
    return json.dumps(steps, ensure_ascii=False)
