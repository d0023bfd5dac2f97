"""Scoring prompts with a supplied callable, in Arrow batches."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

#: A scorer maps a list of prompts to one raw response each: a dict with the fields of
#: :data:`turnsieve.schemas.RESPONSE`.
Scorer = Callable[[list[str]], list[dict]]

_FIELDS = schemas.RESPONSE.fieldNames()


def _opened(make_scorer: Callable[[], Scorer]) -> Scorer:
    """A client that cannot be opened fails every prompt of its task, not the job."""
    try:
        return make_scorer()
    except Exception as error:  # noqa: BLE001
        return lambda prompts, error=error: [_failure(error) for _ in prompts]


def _failure(error: Exception) -> dict:
    return {"result_type": "errored", "text": f"API error: {error}", "input_tokens": 0, "output_tokens": 0}


def _answers(scorer: Scorer, prompts: list[str]) -> list[dict]:
    """Failures become rows: a failing batch is tried prompt by prompt, so that one bad prompt does
    not take the others with it."""
    try:
        answers = list(scorer(prompts))
        if len(answers) != len(prompts):
            raise ValueError(f"{len(answers)} answers to {len(prompts)} prompts")
        return answers
    except Exception as error:  # noqa: BLE001
        if len(prompts) == 1:
            return [_failure(error)]
        return [answer for p in prompts for answer in _answers(scorer, [p])]


def score_prompts(
    requests: DataFrame,
    make_scorer: Callable[[], Scorer],
    keys: Sequence[str] = ("shard_id", "custom_id"),
    prompt: str = "prompt",
    static: tuple[str, str] = ("", ""),
    batch_size: int = 64,
    partitions: int | None = None,
) -> DataFrame:
    """Raw responses ``(keys…, result_type, stop_reason, text, input_tokens, output_tokens)``.

    ``make_scorer`` is called once per task, so a client is opened where it is used. ``static`` is put
    around every prompt inside the task, so that a column of bodies can be scored without moving the
    static text (``render.static_text``) through a shuffle or through Arrow. ``partitions``
    sets how many tasks score at once and how much a lost executor has to score again. A scorer may
    be costly and is rarely repeatable: write the result (``session.written``) before using it twice.
    """
    slim = requests.select(*keys, F.coalesce(F.col(prompt), F.lit("")).alias("_prompt"))
    if partitions:
        slim = slim.repartition(partitions, *keys)
    schema = T.StructType([slim.schema[k] for k in keys] + schemas.RESPONSE.fields)

    before, after = static

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = _opened(make_scorer)
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                part = pdf.iloc[start : start + batch_size]
                answers = _answers(scorer, [before + p + after for p in part["_prompt"]])
                out = part[[*keys]].reset_index(drop=True)
                for name in _FIELDS:
                    out[name] = [a.get(name) for a in answers]
                yield out

    return slim.mapInPandas(score, schema)


@dataclass(frozen=True)
class LexicalScorer:
    """A deterministic scorer for tests and dry runs: the score of an axis is the number of its cue
    words in the prompt, at most three."""

    cues: dict[str, tuple[str, ...]] = field(default_factory=dict)
    chars_per_token: int = 4

    def __call__(self) -> Scorer:
        return self.answer

    def answer(self, prompts: list[str]) -> list[dict]:
        return [self._one(p) for p in prompts]

    def _one(self, prompt: str) -> dict:
        low = prompt.lower()
        scores = {
            axis: min(3, sum(cue in low for cue in self.cues.get(axis, ()))) for axis in schemas.AXES
        }
        text = json.dumps({"reasoning": f"cues in {len(prompt)} chars", **scores})
        return {
            "result_type": "succeeded",
            "stop_reason": "end_turn",
            "text": text,
            "input_tokens": len(prompt) // self.chars_per_token,
            "output_tokens": len(text) // self.chars_per_token,
        }
