"""Run settings, their fingerprint, and the guard against mixing runs."""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import DEDUP_PREFIX
from ..operators.render import MAX_OTHER_CHARS, MAX_TURNS, MAX_USER_CHARS, static_text
from ..operators.results import MAX_SCORE, MAX_TOKENS
from ..operators.shards import SHARD_MAX_BYTES, SHARD_MAX_REQUESTS
from ..schemas import AXES

FINGERPRINT_CHARS = 16


def fingerprint(value: object) -> str:
    """Start of the SHA-256 of the value's JSON text with sorted keys."""
    text = json.dumps(value, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:FINGERPRINT_CHARS]


def text_fingerprint(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:FINGERPRINT_CHARS]


def answer_schema() -> dict:
    """JSON schema of an answer: a reasoning and an integer from 0 to 3 on each axis, nothing else."""
    axis = {"type": "integer", "enum": list(range(MAX_SCORE + 1))}
    fields = {"reasoning": {"type": "string"}, **{a: axis for a in AXES}}
    return {
        "type": "object",
        "properties": fields,
        "required": list(fields),
        "additionalProperties": False,
    }


class ConfigDrift(ValueError):
    """A run that was begun with other settings."""


@dataclass(frozen=True)
class RunConfig:
    dataset: str
    model: str
    prefix: str  # static prompt text before the conversation
    suffix: str  # and after it
    language: str | None = "english"
    dedup_prefix: int = DEDUP_PREFIX
    max_tokens: int = MAX_TOKENS
    shard_max_requests: int = SHARD_MAX_REQUESTS
    shard_max_bytes: int = SHARD_MAX_BYTES
    max_turns: int | None = MAX_TURNS  # caps of a rendered conversation; None is no cap
    max_user_chars: int | None = MAX_USER_CHARS
    max_other_chars: int | None = MAX_OTHER_CHARS
    #: Spellings of the language as files have them; they reach the reader as a filter.
    stored_languages: tuple[str, ...] = ()

    # Settings that must not change within a run.
    FIXED = (
        "template_sha", "schema_sha", "model", "dedup_prefix", "language",
        "max_turns", "max_user_chars", "max_other_chars",
    )

    def values(self) -> dict:
        out = asdict(self)
        out["stored_languages"] = ",".join(out["stored_languages"])
        template = "".join(static_text(out.pop("prefix"), out.pop("suffix")))
        return {
            **out,
            "schema_sha": fingerprint(answer_schema()),
            "template_sha": text_fingerprint(template),
        }

    @property
    def fingerprint(self) -> str:
        values = self.values()
        return fingerprint({name: values[name] for name in self.FIXED})

    def output_config(self) -> dict:
        return {"format": {"type": "json_schema", "schema": answer_schema()}}

    def request_overhead(self) -> int:
        """Length of a request's JSON text with an empty id and an empty prompt."""
        params = {
            "model": self.model,
            "max_tokens": self.max_tokens,
            "output_config": self.output_config(),
            "messages": [{"role": "user", "content": ""}],
        }
        return len(json.dumps({"custom_id": "", "params": params}))

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row of settings with the fingerprint."""
        values = {**self.values(), "fingerprint": self.fingerprint}
        return spark.range(1).select(*[F.lit(v).cast("string" if v is None else type(v).__name__.replace("str", "string")).alias(k) for k, v in values.items()])


def drift(stored: dict, config: RunConfig) -> dict:
    """Fixed settings that differ, as ``{name: (stored, current)}``."""
    values = config.values()
    return {n: (stored.get(n), values[n]) for n in config.FIXED if stored.get(n) != values[n]}


def guard(spark: SparkSession, folder: str, config: RunConfig, force: bool = False) -> None:
    """Store the settings of a new run; refuse to go on with a run begun with others.

    A new folder is claimed by creating its file of settings, which one of any number of callers can do; the
    others are held against the winner's.
    """
    path = f"{folder.rstrip('/')}/config"
    if not folder_exists(spark, path):
        settings = json.dumps({**config.values(), "fingerprint": config.fingerprint})
        if create_once(spark, f"{path}/settings.json", settings):
            return
    changed = drift(stored_settings(spark, folder, config), config)
    if changed and not force:
        raise ConfigDrift(f"settings differ from those of the run in {folder}: {changed}")


def stored_settings(spark: SparkSession, folder: str, config: RunConfig) -> dict:
    row = spark.read.schema(config.frame(spark).schema).json(f"{folder.rstrip('/')}/config").first()
    return row.asDict() if row else {}


def drifted_shards(lines: DataFrame, config: RunConfig) -> DataFrame:
    """``(shard_id, fingerprint, n_requests, drifted)`` of stored shard lines: what was prepared under which settings.

    A line without a fingerprint has drifted. Partial counts; requests are not read.
    """
    sizes = lines.groupBy("shard_id", "fingerprint").agg(F.count(F.lit(1)).alias("n_requests"))
    return sizes.withColumn("drifted", ~F.col("fingerprint").eqNullSafe(config.fingerprint))


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with all of its text unless there is one: of any number of callers one gets ``True``.

    The text is written aside and then moved in place, which file systems of clusters refuse if the place is taken. On a
    local disk a move would replace the file, so there it is linked.
    """
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    aside = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(aside)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if files.getScheme() != "file":
            return not files.exists(place) and files.rename(aside, place)
        local = jvm.java.nio.file.Paths
        as_path = [local.get(files.makeQualified(p).toUri()) for p in (place, aside)]
        jvm.java.nio.file.Files.createLink(*as_path)
        return True
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise
    finally:
        files.delete(aside, False)


def folder_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
