"""Frames derived from the given tables, standing for sources, score tables and raw answers.

Every frame is made by projections, unions and joins of whole tables; nothing is grouped here. The SQL
forms of the same frames are in :mod:`turnsieve.checks.oracles`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.turns import turn
from ..operators.conversations import records
from ..plans.config import RunConfig

PREFIX = "Grade the conversation.\n\n"
SUFFIX = "\n\nAnswer with one JSON object."

#: Settings of runs over the test tables: small shards, so that packing has something to do.
RUN = RunConfig(
    dataset="documents",
    model="test-model",
    prefix=PREFIX,
    suffix=SUFFIX,
    language="en",
    shard_max_requests=50,
    shard_max_bytes=100_000,
)
CUES = {
    "conceptual": ("th", "qu", "sch", "é"),
    "novelty": ("x", "z", "!", "?"),
    "well_formed": ("the ", "der ", "le ", "la "),
}
FILE_ROWS = 250


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(number: Column, *values: Column | str | None) -> Column:
    """``values[number % len(values)]``."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, value in enumerate(values):
        value = value if isinstance(value, Column) else F.lit(value)
        out = out.when(number % len(values) == i, value)
    return out


# -- conversations ------------------------------------------------------------------------------


def chat_turns(spark: SparkSession, sf_dir: str, blanks: bool = False) -> DataFrame:
    """Long table of turns with metadata; optionally some turns are white space only."""
    text = F.col("text")
    if blanks:
        text = F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, F.lit("   ")).otherwise(text)
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conv_"), F.col("conv_id")).alias("id"),
        F.col("conv_id").alias("row_idx"),
        "turn",
        "role",
        text.alias("content"),
    )


def long_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of ten conversations under one id: conversations of many more turns."""
    number = F.floor(F.col("row_idx") / 10).cast("bigint")
    return chat_turns(spark, sf_dir, blanks=True).select(
        F.concat(F.lit("long_"), number).alias("id"),
        number.alias("row_idx"),
        (1000 * (F.col("row_idx") % 10) + F.col("turn")).alias("turn"),
        "role",
        "content",
    )


def sender_turns(spark: SparkSession, sf_dir: str, blanks: bool = False) -> DataFrame:
    """The same in ``from``/``value`` spelling."""
    role = F.col("role")
    sender = (
        F.when(role == "user", "human").when(role == "assistant", "gpt").otherwise(role)
    )
    return chat_turns(spark, sf_dir, blanks).select(
        "id", "row_idx", "turn", sender.alias("from"), F.col("content").alias("value")
    )


def chat_language() -> Column:
    return pick(F.col("row_idx"), "English", "english", "German", None)


def stored_chats(spark: SparkSession, sf_dir: str, role: str = "role", content: str = "content") -> DataFrame:
    """Conversations as sources store them: one row with an array of turns, in either spelling."""
    turns = chat_turns(spark, sf_dir, blanks=True) if role == "role" else sender_turns(spark, sf_dir, blanks=True)
    rows = turns.groupBy("id", "row_idx").agg(F.sort_array(F.collect_list(F.struct("turn", role, content))).alias("_turns"))
    stored = F.transform("_turns", lambda t: F.struct(t[role].alias(role), t[content].alias(content)))
    return rows.select("id", "row_idx", stored.alias("turns"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message tree: the first turn of a conversation is a root, every other turn has a parent."""
    number = F.col("row_idx")
    return chat_turns(spark, sf_dir, blanks=True).select(
        "row_idx",
        F.concat("id", F.lit("_"), F.col("turn")).alias("message_id"),
        F.when(F.col("turn") > 0, F.concat("id", F.lit("_"), F.col("turn") - 1)).alias("parent_id"),
        F.concat(F.lit(" "), F.col("content"), F.lit("\n")).alias("text"),
        F.when(F.col("role") == "assistant", "assistant").otherwise("prompter").alias("role"),
        pick(number, "en", "en", "EN", None).alias("lang"),
        F.when(number % 5 == 0, F.lit(None)).otherwise(number % 5 == 1).alias("deleted"),
    )


# -- documents ------------------------------------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def document_language() -> Column:
    lang = F.col("lang")
    return pick(F.col("doc_id"), F.upper(lang), lang, F.initcap(lang), lang, None)


def document_ids() -> Column:
    """Ids of every shape: usable, repeated, with a space, empty, null, too long, ending in a line feed, and
    such as are made up for rows without one."""
    doc_id = F.col("doc_id")
    return (
        F.when(doc_id % 11 == 0, F.concat(F.lit("doc "), doc_id))
        .when(doc_id % 13 == 0, F.lit(""))
        .when(doc_id % 17 == 0, F.lit(None))
        .when(doc_id % 19 == 0, F.lpad(doc_id.cast("string"), 65, "0"))
        .when(doc_id % 23 == 0, F.lpad(doc_id.cast("string"), 64, "0"))
        .when(doc_id % 29 == 0, F.concat(F.lit("doc_"), doc_id, F.lit("\n")))
        .when(doc_id % 31 == 0, F.concat(F.lit("row_"), F.lpad((doc_id % 250).cast("string"), 6, "0")))
        .when(doc_id % 37 == 0, F.concat(F.lit("r"), F.lpad((doc_id + 1).cast("string"), 7, "0")))
        .when(doc_id % 5 == 0, F.concat(F.lit("doc_"), doc_id - 1))
        .otherwise(F.concat(F.lit("doc_"), doc_id))
    )


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as one-turn conversations in files of some hundred rows."""
    return as_document_records(documents(spark, sf_dir))


def as_document_records(df: DataFrame) -> DataFrame:
    df = df.select(
        "doc_id", "text", "lang", F.col("source"),
        F.floor(F.col("doc_id") / FILE_ROWS).cast("bigint").alias("file_idx"),
        F.col("doc_id").alias("row_idx"),
    )
    return records(
        df,
        source=F.lit("documents"),
        id=F.coalesce(document_ids(), F.lit("")),
        conversation=F.array(turn(F.lit("user"), F.col("text"))),
        language=F.when(F.col("doc_id") % 4 == 0, F.upper("lang")).otherwise(F.col("lang")),
        src_model=F.col("source"),
        src_turn=F.lit(1),
    )


def question_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question and answer rows: some with turns, some with a question only, some with neither."""
    left = documents(spark, sf_dir)
    right = left.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("completion"))
    doc_id = F.col("doc_id")

    def sent(sender: str, value: Column) -> Column:
        return F.struct(F.lit(sender).alias("from"), value.alias("value"))

    return left.join(right, "doc_id", "left").select(
        doc_id.alias("row_idx"),
        F.when(doc_id % 5 == 0, F.lit("")).otherwise(F.col("text")).alias("instruction"),
        "completion",
        F.when(
            doc_id % 3 == 0,
            F.array(sent("human", F.col("source")), sent("gpt", F.col("completion"))),
        ).alias("conversations"),
    )


def printed_conversation() -> Column:
    """A question and an answer as the printed form of an array, with either quote."""
    quote = F.when(F.col("doc_id") % 2 == 0, F.lit("'")).otherwise(F.lit('"'))

    def quoted(text: Column) -> Column:
        for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r")):
            text = F.replace(text, F.lit(plain), F.lit(escaped))
        return F.concat(quote, F.replace(text, quote, F.concat(F.lit("\\"), quote)), quote)

    def element(role: str, text: Column) -> Column:
        return F.concat(
            F.lit(f"{{'role': '{role}', 'content': array([{{'type': 'text', 'text': "),
            quoted(text),
            F.lit(", 'image': None}], dtype=object), 'num_tokens': None}"),
        )

    return F.concat(
        F.lit("["),
        element("user", F.col("text")),
        F.lit("\n "),
        element("assistant", F.col("source")),
        F.lit("]"),
    )


# -- pages ------------------------------------------------------------------------------------------


def forum_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    page_id = F.col("page_id")
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    return table(spark, sf_dir, "pages").select(
        page_id.alias("row_idx"),
        F.concat(F.lit("post_"), page_id).alias("post_id"),
        F.when(page_id % 2 == 0, F.concat(title, F.lit("? "))).otherwise(title).alias("title"),
        F.col("html").alias("htmlBody"),
        F.col("url").alias("pageUrl"),
        (page_id % 50).alias("baseScore"),
        F.timestamp_seconds(F.lit(1_700_000_000) + page_id * 86_399).alias("postedAt"),
        F.when(page_id % 3 > 0, page_id % 3 == 1).alias("question"),
    )


def nested_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("title", "htmlBody", "question", "pageUrl", "baseScore", "postedAt")
    return forum_posts(spark, sf_dir).select(
        "row_idx", F.struct(F.col("post_id").alias("_id"), *fields).alias("post")
    )


# -- answers and scores ------------------------------------------------------------------------------


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").join(documents(spark, sf_dir), "doc_id")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score table: refusals without scores, keys that are not in the source, and repeated keys."""
    doc_id = F.col("doc_id")
    refused = doc_id % 17 == 0

    def axis(value: Column) -> Column:
        return F.when(~refused, value).cast("int")

    base = labelled(spark, sf_dir).select(
        doc_id.alias("ord"),
        "source",
        F.when(doc_id % 29 == 0, F.concat(F.lit("gone_"), doc_id))
        .otherwise(F.concat(F.lit("doc_"), doc_id))
        .alias("key"),
        axis(2 * F.col("quality") + doc_id % 2).alias("conceptual"),
        axis(F.floor(F.col("n_chars") / 10) % 4).alias("novelty"),
        axis(3 - 2 * F.col("toxic")).alias("well_formed"),
        F.when(refused, F.lit("refusal"))
        .when(doc_id % 31 == 0, F.lit(None))
        .otherwise(F.lit("ok"))
        .alias("status"),
        F.when(doc_id % 4 < 3, F.col("lang")).alias("language"),
        F.lpad((doc_id % 7).cast("string"), 4, "0").alias("shard_id"),
        F.concat(F.lit("doc_"), doc_id).alias("custom_id"),
        (F.col("n_chars") * 3).alias("input_tokens"),
        (doc_id % 200).alias("output_tokens"),
    )
    again = base.where(F.col("ord") % 23 == 0).withColumns(
        {"ord": F.col("ord") + 1_000_000_000, "novelty": F.lit(3), "conceptual": F.lit(2)}
    )
    return base.unionByName(again)


def unique_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One result per request: the first of each repeated row."""
    return scores(spark, sf_dir).where(F.col("ord") < 1_000_000_000)


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw answers of every kind; some to requests that nobody made."""
    doc_id = F.col("doc_id")
    c, n, w = (
        (2 * F.col("quality") + doc_id % 2).cast("string"),
        (F.floor(F.col("n_chars") / 10) % 4).cast("bigint").cast("string"),
        (3 - 2 * F.col("toxic")).cast("string"),
    )

    def answer(first: Column, rest: str = ', "reasoning": "because"') -> Column:
        return F.concat(
            F.lit('{"conceptual": '), first, F.lit(', "novelty": '), n, F.lit(', "well_formed": '), w,
            F.lit(f"{rest}}}"),
        )

    quoted = F.concat(F.lit('" '), c, F.lit('"'))
    text = (
        F.when(doc_id % 11 == 1, F.concat(F.lit('{"conceptual": '), c, F.lit(", ")))
        .when(doc_id % 11 == 2, F.concat(F.lit('{"novelty": '), n, F.lit("}")))
        .when(doc_id % 11 == 3, answer(quoted))
        .when(doc_id % 11 == 4, F.concat(F.lit("["), c, F.lit("]")))
        .when(doc_id % 11 == 5, answer(F.lit("null")))
        .when(doc_id % 11 == 6, answer(F.lit('"2.7"')))
        .when(doc_id % 11 == 7, answer(F.lit("7")))
        .when(doc_id % 11 == 8, answer(c, ""))
        .when(doc_id % 11 == 9, answer(F.concat(c, F.lit(".7"))))
        .when(doc_id % 11 == 10, answer(F.lit("true"), ', "reasoning": null'))
        .otherwise(answer(c))
    )
    kind = (
        F.when(doc_id % 37 == 0, F.lit("errored"))
        .when(doc_id % 41 == 0, F.lit("expired"))
        .when(doc_id % 43 == 0, F.lit(None))
        .otherwise(F.lit("succeeded"))
    )
    return labelled(spark, sf_dir).select(
        F.lpad((doc_id % 7).cast("string"), 4, "0").alias("shard_id"),
        F.concat(F.when(doc_id % 47 == 0, F.lit("none_")).otherwise(F.lit("doc_")), doc_id).alias("custom_id"),
        F.concat(F.lit("batch_"), doc_id % 7).alias("batch_id"),
        kind.alias("result_type"),
        F.when(doc_id % 13 == 0, F.lit("refusal")).otherwise(F.lit("end_turn")).alias("stop_reason"),
        text.alias("text"),
        F.col("n_chars").alias("input_tokens"),
        F.when(doc_id % 3 > 0, doc_id % 200).alias("output_tokens"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per document in shards; documents without a label have no answer."""
    doc_id = F.col("doc_id")
    return documents(spark, sf_dir).select(
        F.lpad((doc_id % 7).cast("string"), 4, "0").alias("shard_id"),
        F.concat(F.lit("doc_"), doc_id).alias("custom_id"),
        F.when(doc_id % 3 > 0, F.lit(300) + 100 * (doc_id % 9)).alias("max_tokens"),
        F.col("text").alias("prompt"),
    )


def request_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of all requests; answers with a made-up id find none."""
    doc_id = F.col("doc_id")
    return documents(spark, sf_dir).select(
        F.lpad((doc_id % 7).cast("string"), 4, "0").alias("shard_id"),
        F.concat(F.lit("doc_"), doc_id).alias("custom_id"),
        F.concat(F.lit("doc_"), doc_id).alias("conversation_hash"),
        "source",
        F.col("lang").alias("language"),
        F.lit(1).cast("bigint").alias("n_turns"),
        F.lit(None).cast("string").alias("src_model"),
        F.lit(None).cast("string").alias("timestamp"),
        F.lit(None).cast("string").alias("country"),
        (doc_id % 50).alias("base_score"),
        F.lit(None).cast("string").alias("url"),
    )


def keyed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a source to rebuild from; some keys occur twice, the second time with other text."""
    df = documents(spark, sf_dir)
    doc_id = F.col("doc_id")
    copies = df.where(doc_id % 19 == 0).withColumn("text", F.upper("text")).withColumn("_copy", F.lit(1))
    both = df.withColumn("_copy", F.lit(0)).unionByName(copies)
    both = both.select(
        "*",
        (20240115 + doc_id % 3).alias("file_idx"),  # files named by their date
        (2 * doc_id + F.col("_copy")).alias("row_idx"),
    )
    return records(
        both,
        source=F.lit("documents"),
        id=F.concat(F.lit("doc_"), doc_id),
        conversation=F.array(turn(F.lit("user"), F.col("text"))),
        title=F.substring("text", 1, 100),
        url=F.concat(F.lit("http://example.com/"), doc_id),
    )
