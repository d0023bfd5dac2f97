"""Names of the sources, how each is read, and where its scores are."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .. import schemas
from . import adapters


@dataclass(frozen=True)
class Source:
    scores: str  # folder or file of the published scores
    schema: T.StructType
    adapter: Callable[[DataFrame], DataFrame]
    key: str  # what the published key is


# The sites of the generic question-and-answer dumps.
QA_SITES = (
    "hermeneutics",
    "linguistics",
    "law",
    "hsm",
    "politics",
    "christianity",
    "opensource",
    "mythology",
    "parenting",
    "vegetarianism",
    "matheducators",
    "cseducators",
)

# Source names and the names of their score tables.
SOURCES: dict[str, Source] = {
    "wildchat": Source(
        "english_full", schemas.CHAT_LOG, adapters.chat_log, "conversation_hash"
    ),
    "lesswrong": Source(
        "lesswrong_questions", schemas.FORUM_FLAGGED, adapters.forum_flagged, "post._id"
    ),
    "eaforum": Source(
        "eaforum_questions", schemas.FORUM_TITLED, adapters.forum_interrogative, "post_id"
    ),
    "philosophy_se": Source(
        "philosophy_se", schemas.QA_PAIRS, adapters.qa_with_fallback, "digest of the instruction"
    ),
    "sharegpt": Source("sharegpt", schemas.SHARED_CHAT, adapters.shared_chat, "id"),
    "prism": Source("prism", schemas.PREFERENCE_CHAT, adapters.preference_chat, "conversation_id"),
    "arena_140k": Source(
        "arena_140k",
        schemas.ARENA_BLOCKS,
        partial(adapters.arena, rules=adapters.ARENA["arena_140k"]),
        "id",
    ),
    "arena_expert": Source(
        "arena_expert",
        schemas.ARENA_PRINTED,
        partial(adapters.arena, rules=adapters.ARENA["arena_expert"]),
        "id",
    ),
    "oasst2": Source("oasst2", schemas.MESSAGE_TREE, adapters.tree_roots, "message_id"),
    "lmsys": Source("lmsys", schemas.GATED_CHAT, adapters.gated_chat, "conversation_id"),
    **{
        f"se_{site}": Source(
            f"se_{site}",
            schemas.QA_SITE,
            partial(adapters.qa_site, site=site),
            "digest of the first turn left",
        )
        for site in QA_SITES
    },
}


def source_records(name: str, df: DataFrame) -> DataFrame:
    return SOURCES[name].adapter(df)


def all_sources(frames: list[DataFrame]) -> DataFrame:
    """One table of records; columns are matched by name and missing ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
