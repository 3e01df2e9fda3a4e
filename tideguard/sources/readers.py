"""Readers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideguard.config import LABELS, SYNTHETIC_USERS
from tideguard.functions.hashing import synthetic_user, whole_number

COMMENT_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("comment_text", T.StringType())]
    + [T.StructField(x, T.IntegerType()) for x in LABELS])

# The one schema every labelled corpus is brought to.
HARMONISED_SCHEMA = T.StructType(
    [T.StructField("comment_text", T.StringType())]
    + [T.StructField(x, T.IntegerType()) for x in LABELS]
    + [T.StructField("source", T.StringType())])

_CORRUPT = "__unread"

POST_SCHEMA = T.MapType(T.StringType(), T.StructType([
    T.StructField("post_tokens", T.ArrayType(T.StringType())),
    T.StructField("annotators", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType())])))]))


def read_parallel(spark: SparkSession, path: str, key: str, tasks: int | None = None) -> DataFrame:
    """Parquet whose rows are costly to process (long text).

    It is read as it lies. A caller who knows that the files have fewer row
    groups than the cluster has cores can ask for ``tasks`` tasks; the rows are
    then dealt out by ``key``, which costs a shuffle of all columns.
    """
    df = spark.read.parquet(path)
    return df.repartition(tasks, key) if tasks else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             line_breaks: bool = True) -> DataFrame:
    """CSV with a header, doubled quotes and, by default, quoted line breaks.

    A row that does not fit the schema is an error; ``split_csv`` sets such rows aside.
    A file with quoted line breaks cannot be split, so each file is one task:
    have many files of moderate size, and convert them to Parquet once. Without
    line breaks (``line_breaks=False``) large files split.
    """
    return spark.read.schema(schema).csv(path, header=True, multiLine=line_breaks, escape='"', mode="FAILFAST")


def split_csv(spark: SparkSession, path: str, schema: T.StructType,
              line_breaks: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows that fit the schema, and (value, reason) of all others, as ``read_csv`` reads.

    Every row is in one of the two. All columns are parsed, whichever are asked for,
    so that a row is judged alike in both.
    """
    checked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    rows = spark.read.schema(checked).csv(path, header=True, multiLine=line_breaks, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT)
    # Always true, but it needs every column, and the parser checks only those that are needed.
    rows = rows.filter(F.xxhash64(*schema.names).bitwiseOR(F.lit(1)) != 0)
    bad = rows.filter(F.col(_CORRUPT).isNotNull()).select(F.col(_CORRUPT).alias("value"), F.lit("bad_row").alias("reason"))
    return rows.filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT), bad


def check_posts(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """(post_id, post_tokens, votes, reason, value): every post, and every record that gives none.

    ``reason`` is NULL for a good post. ``not_json`` and ``no_posts`` (not an object
    with posts) are whole records, with their text in ``value``; ``bad_tokens`` and
    ``bad_votes`` are posts of which that part is missing or of another shape. Blank
    lines are no records.
    """
    raw = spark.read.text(path, wholetext=whole_files).filter(F.trim("value") != "")
    # The outer form parses each line once, see one_row_each.
    posts = raw.select("value", F.explode_outer(F.from_json("value", POST_SCHEMA)).alias("post_id", "post"))
    reason = (F.when(F.col("post_id").isNull(), F.when(F.try_parse_json("value").isNull(), "not_json").otherwise("no_posts"))
              .when(F.col("post.post_tokens").isNull(), "bad_tokens")
              .when(F.col("post.annotators").isNull(), "bad_votes"))
    return posts.select("post_id", "post.post_tokens", F.col("post.annotators.label").alias("votes"), reason.alias("reason"),
                        F.when(reason.isNotNull(), F.col("value")).alias("value"))


def split_posts(spark: SparkSession, path: str, whole_files: bool = False) -> tuple[DataFrame, DataFrame]:
    """The good posts (post_id, post_tokens, votes), and (value, post_id, reason) of what could not be read."""
    checked = check_posts(spark, path, whole_files)
    return (checked.filter("reason IS NULL").select("post_id", "post_tokens", "votes"),
            checked.filter("reason IS NOT NULL").select("value", "post_id", "reason"))


def read_posts(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """JSON objects ``{post_id: {post_tokens, annotators}}`` to one row per post.

    By default every line is one object, so files split and each task sees
    single lines. ``whole_files`` is for an object printed over many lines;
    each such file is one task. What cannot be read is an error; ``split_posts``
    sets it aside.
    """
    checked = check_posts(spark, path, whole_files)
    loud = F.raise_error(F.concat_ws(" ", F.lit("cannot read a post:"), "reason", F.substring("value", 1, 200)))
    return checked.filter(F.when(F.col("reason").isNull(), True).otherwise(loud.cast("boolean"))).select("post_id", "post_tokens", "votes")


def fill_prediction_defaults(df: DataFrame, key: str = "id") -> DataFrame:
    """Adds the columns reports need and a predictions table may lack."""
    added = {}
    if "user_id" not in df.columns:
        number = whole_number(F.col(key), df.schema[key].dataType)
        added["user_id"] = synthetic_user(number, SYNTHETIC_USERS)
    if "comment_text" not in df.columns:
        added["comment_text"] = F.lit("")
    return df.withColumns(added)


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    return fill_prediction_defaults(spark.read.parquet(path))
