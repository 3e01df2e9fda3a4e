"""Catalogue entries on documents: text, sources, sinks, harmonising, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideguard.config import DEFAULT_LEXICON, LABELS, THRESHOLDS
from tideguard.functions.hashing import stable_row_id
from tideguard.operators.ids import number_copies
from tideguard.functions.labels import (
    CLASS_CODE_LABELS, labels_from_class, labels_from_grades,
)
from tideguard.functions.scoring import apply_thresholds, sigmoid
from tideguard.functions.text import (
    STOP_WORDS, clean_text, clean_tokens, model_tokens, tokenize_regex, tokenize_whitespace,
)
from tideguard.functions.rows import one_row_each
from tideguard.operators import features, filters, harmonize, profile, reports, sampling, scoring
from tideguard.plans import sql_parts as sql
from tideguard.plans.fixtures import (
    SCORE_PARAMETERS, labelled_documents, long_texts, predictions, six_label_comments, table,
)
from tideguard.session import fresh_path
from tideguard.sources import readers, writers

# Fixed values of the fixtures below.
SAMPLE_SHARE = 0.25


def _sparse_text(spark, sf_dir):
    """All documents, and beside them a row without text for each one without a label."""
    docs = labelled_documents(spark, sf_dir)
    return docs.select("id", "comment_text").unionByName(docs.filter("quality IS NULL").select(
        (-1 - F.col("id")).alias("id"), F.lit(None).cast("string").alias("comment_text")))


def _digits_text(spark, sf_dir):
    """All documents, and beside them a bare number for each one without a label."""
    docs = labelled_documents(spark, sf_dir)
    return docs.select("id", "comment_text").unionByName(docs.filter("quality IS NULL").select(
        (-1 - F.col("id")).alias("id"), F.col("n_chars").cast("string").alias("comment_text")))


def _documents(spark, sf_dir):
    return long_texts(spark, sf_dir).select(
        F.col("doc_id").alias("id"), F.col("text").alias("comment_text"))


# --- sources and sinks ------------------------------------------------------

def csv_scan(spark, sf_dir):
    path = fresh_path(spark, "comments-csv")
    writers.write_report(six_label_comments(spark, sf_dir).drop("source"), path, single_file=False)
    return readers.read_csv(spark, path, readers.COMMENT_SCHEMA)


def parquet_scan(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter(F.col("text").isNotNull()).select(
        F.col("doc_id").alias("id"), "source", "n_chars")


def partition_pruned_scan(spark, sf_dir):
    path = fresh_path(spark, "comments-by-toxic")
    writers.write_partitioned(six_label_comments(spark, sf_dir), path, "toxic")
    return spark.read.parquet(path).filter("toxic = 1").select(
        "id", "comment_text", *LABELS, "source")


def parquet_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "comments")
    writers.write_table(six_label_comments(spark, sf_dir), path)
    return spark.read.parquet(path)


def report_csv_roundtrip(spark, sf_dir):
    report = reports.category_breakdown(apply_thresholds(predictions(spark, sf_dir)))
    path = fresh_path(spark, "category-report")
    writers.write_report(report, path)
    return readers.read_csv(spark, path, report.schema)


def staged_publish(spark, sf_dir):
    """A first version, then a second one in its place."""
    path = fresh_path(spark, "published")
    comments = six_label_comments(spark, sf_dir)
    writers.publish(comments, path)
    writers.publish(comments.withColumn("comment_text", clean_text(F.col("comment_text"))), path)
    return spark.read.parquet(path)


def verify_readback(spark, sf_dir):
    path = fresh_path(spark, "verified")
    comments = six_label_comments(spark, sf_dir)
    writers.write_table(comments, path)
    return writers.verify_readback(spark, path, comments)


def _posts(spark, sf_dir):
    """Documents as annotated posts: tokens, and three votes."""
    docs = labelled_documents(spark, sf_dir)
    votes = F.array(
        F.when(F.col("toxic") == 1, "hatespeech").otherwise("normal"),
        F.when(F.col("quality") == 0, "offensive").otherwise("undecided"),
        F.when(F.col("lang") == "en", "normal").otherwise("hatespeech"))
    return docs.select(
        F.col("id").cast("string").alias("post_id"),
        F.split("comment_text", r"\s+").alias("post_tokens"), votes.alias("votes"))


def _posts_from_json(spark, sf_dir):
    """The same posts, written as JSON objects keyed by post id and read back."""
    post = F.struct("post_tokens", F.transform(
        "votes", lambda v: F.struct(v.alias("label"))).alias("annotators"))
    path = fresh_path(spark, "posts-json")
    (_posts(spark, sf_dir).select(F.to_json(F.create_map("post_id", post)).alias("value"))
     .write.text(path))
    return readers.read_posts(spark, path)


# Every so manyth line of the posts is cut off, has tokens of another shape, or is no object.
CUT_OFF, NO_TOKENS, NO_OBJECT = 11, 13, 17


def posts_with_quarantine(spark, sf_dir):
    """Posts of which some lines are broken: those that can be read, and why the others cannot."""
    number = F.col("post_id").cast("long")
    post = F.struct("post_tokens", F.transform("votes", lambda v: F.struct(v.alias("label"))).alias("annotators"))
    whole = F.to_json(F.create_map("post_id", post))
    broken = F.to_json(F.create_map("post_id", F.struct(F.lit("x").alias("post_tokens"), F.lit(None).cast("string").alias("annotators"))))
    line = (F.when(number % CUT_OFF == 0, F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int")))
            .when(number % NO_TOKENS == 0, broken).when(number % NO_OBJECT == 0, F.lit("[1, 2]")).otherwise(whole))
    path = fresh_path(spark, "broken-posts")
    _posts(spark, sf_dir).select(line.alias("value")).write.text(path)
    good, bad = readers.split_posts(spark, path)
    return (good.select("post_id", F.size("post_tokens").alias("n_tokens"), F.size("votes").alias("n_votes"), F.lit(None).cast("string").alias("reason"))
            .unionByName(bad.select("post_id", "reason"), allowMissingColumns=True))


def row_id_of_copies(spark, sf_dir):
    """Ids for rows without any, where a third of the rows share a text and a source."""
    third = F.col("id") % 3 == 0
    rows = six_label_comments(spark, sf_dir).select(
        F.when(third, "the same words").otherwise(F.col("comment_text")).alias("comment_text"),
        F.when(third, "copies").otherwise(F.col("source")).alias("source"))
    return number_copies(rows.repartition(7), ["comment_text", "source"])


def publish_in_one_pass(spark, sf_dir):
    """Two sources published as one table, with the rows per source that were counted on the way."""
    path = fresh_path(spark, "published-sources")
    comments = harmonize.from_six_labels(six_label_comments(spark, sf_dir), "documents", drop_empty=True)
    turns = table(spark, sf_dir, "conversations").withColumn("class", F.lit(2))
    return writers.publish_sources([comments, harmonize.from_class_code(turns, "conversations", text="text", drop_empty=True)], path)


def nested_json_scan(spark, sf_dir):
    voted = harmonize.with_vote_labels(_posts_from_json(spark, sf_dir))
    return voted.withColumn("comment_text", clean_text(F.col("comment_text")))


# --- harmonising ------------------------------------------------------------

def _class_code():
    return (F.when(F.col("event_type") == "error", 0)
            .when(F.col("event_type") == "click", 1).otherwise(2))


def harmonize_class_code(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", *labels_from_class(_class_code(), CLASS_CODE_LABELS))


def _graded(spark, sf_dir):
    """Events as graded scores; some scores are missing."""
    v = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat("event_type", F.lit(" "), "props").alias("comment_text"),
        (v / 100).alias("target"), (v / 200).alias("severe_toxicity"),
        F.when(F.col("event_type") != "view", v / 50).alias("obscene"),
        (v / 150).alias("threat"), (v / 75).alias("insult"),
        F.when(F.col("event_type") != "click", v / 90).alias("identity_attack"))


def harmonize_graded(spark, sf_dir):
    return _graded(spark, sf_dir).select("event_id", *labels_from_grades())


def majority_vote(spark, sf_dir):
    votes = table(spark, sf_dir, "events").withColumn(
        "vote", F.when(F.col("event_type") == "error", "hatespeech")
        .when(F.col("event_type") == "click", "offensive").otherwise(F.col("event_type")))
    return harmonize.majority_vote(votes, "user_id", "vote", ["ts", "event_id"])


def harmonize_union(spark, sf_dir):
    """Four corpora of different shapes under one schema."""
    turns = table(spark, sf_dir, "conversations").withColumn(
        "class", F.when(F.col("role") == "system", 0).when(F.col("role") == "user", 1)
        .otherwise(2))
    return harmonize.union_sources(
        harmonize.from_six_labels(six_label_comments(spark, sf_dir), "documents"),
        harmonize.from_class_code(turns, "conversations", text="text", drop_empty=True),
        harmonize.from_graded(_graded(spark, sf_dir), "events"),
        harmonize.from_posts(_posts(spark, sf_dir), "posts", drop_empty=True))


def source_breakdown(spark, sf_dir):
    return profile.source_breakdown(six_label_comments(spark, sf_dir))


def label_projection(spark, sf_dir):
    return six_label_comments(spark, sf_dir).select(
        "comment_text", F.col("toxic").cast("double").alias("label"))


def null_counts(spark, sf_dir):
    return profile.null_counts(labelled_documents(spark, sf_dir))


def table_profile(spark, sf_dir):
    return profile.table_profile(labelled_documents(spark, sf_dir))


# --- text -------------------------------------------------------------------

def _joined(tokens):
    return F.array_join(tokens, " ").alias("tokens"), F.size(tokens).alias("n_tokens")


def clean_text_query(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "id", clean_text(F.col("comment_text")).alias("cleaned"))


def tokenize_whitespace_query(spark, sf_dir):
    return _documents(spark, sf_dir).select("id", F.array_join(
        tokenize_whitespace(F.col("comment_text")), "|").alias("tokens"))


def tokenize_regex_query(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "id", *_joined(tokenize_regex(clean_text(F.col("comment_text")))))


def remove_stopwords_query(spark, sf_dir):
    return _documents(spark, sf_dir).select("id", *_joined(model_tokens(F.col("comment_text"))))


def stopword_anti_join(spark, sf_dir):
    """How often each word that is not a stop word occurs."""
    stop = spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")
    words = one_row_each(_documents(spark, sf_dir), "word",
                         clean_tokens(clean_text(F.col("comment_text"))))
    # A fixed list of 181 words, hence the broadcast.
    return (words.join(F.broadcast(stop), "word", "left_anti")
            .groupBy("word").agg(F.count("*").alias("n")))


def drop_null_text(spark, sf_dir):
    return filters.drop_null_text(_sparse_text(spark, sf_dir))


def drop_empty_clean(spark, sf_dir):
    return filters.drop_empty_clean(_digits_text(spark, sf_dir))


def _messages(spark, sf_dir):
    """Conversation turns and documents as messages; system turns are commands.
    Beside them stand messages without text, or of blanks, one for each document
    without a label."""
    turns = table(spark, sf_dir, "conversations").select(
        F.concat_ws(":", F.lit("turn"), "conv_id", "turn").alias("id"),
        F.when(F.col("role") == "system", F.concat(F.lit("/"), "text"))
        .otherwise(F.col("text")).alias("text"))
    docs = labelled_documents(spark, sf_dir)
    whole = docs.select(F.concat_ws(":", F.lit("doc"), "id").alias("id"), F.col("comment_text").alias("text"))
    blank = docs.filter("quality IS NULL").select(
        F.concat_ws(":", F.lit("blank"), "id").alias("id"),
        F.when(F.col("lang") == "en", F.lit(" \n\t ")).alias("text"))
    return turns.unionByName(whole).unionByName(blank)


def validate_comments(spark, sf_dir):
    return filters.validate_comments(_messages(spark, sf_dir), "text").select(
        "id", "reason", "accepted")


def admit_messages(spark, sf_dir):
    return filters.admit_messages(_messages(spark, sf_dir), "text")


def _scored_documents(spark, sf_dir):
    return _documents(spark, sf_dir).select("id", "comment_text", *[
        (((F.col("id") * a + b) % 1000) / F.lit(1000.0)).alias(f"prob_{x}")
        for x, (a, b) in SCORE_PARAMETERS.items()])


def lexicon_override(spark, sf_dir):
    """The lexicon is a table: all words of the benchmark passages."""
    words = one_row_each(table(spark, sf_dir, "benchmark"), "word",
                         tokenize_regex(clean_text(F.col("text"))))
    lexicon = words.filter(F.length("word") > 0)
    scored = _scored_documents(spark, sf_dir)
    hits = filters.lexicon_matches(scored, lexicon, "id", "comment_text").withColumn(
        "hit", F.lit(True))
    flags = apply_thresholds(scored.drop("comment_text")).join(hits, "id", "left")
    return filters.override_by_lexicon(flags, F.coalesce("hit", F.lit(False))).select(
        "id", *[f"flag_{x}" for x in LABELS],
        *[f"flagged_by_{x}" for x in LABELS[:3]], "prob1_toxic")


def lexicon_default(spark, sf_dir):
    """The built-in list: a model flag or a listed word flags a comment."""
    flags = apply_thresholds(_scored_documents(spark, sf_dir))
    return filters.override_by_lexicon(flags, filters.lexicon_hit(F.col("comment_text"))).select(
        "id", *[f"flag_{x}" for x in LABELS], "flagged_by_toxic")


# --- samples, splits, weights -----------------------------------------------

def stable_row_id_query(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir)
    return rows.select("id", stable_row_id(
        F.col("comment_text"), F.col("source"), F.col("quality")).alias("row_id"))


def hash_sample(spark, sf_dir):
    return sampling.hash_sample(_documents(spark, sf_dir), SAMPLE_SHARE)


def train_test_split(spark, sf_dir):
    return _documents(spark, sf_dir).select("id", F.when(
        sampling.in_train(F.col("id")), "train").otherwise("test").alias("part"))


def class_weights(spark, sf_dir):
    return sampling.with_class_weights(six_label_comments(spark, sf_dir)).select(
        "id", *[F.round(f"w_{x}", 6).alias(f"w_{x}") for x in LABELS])


def class_weight_summary(spark, sf_dir):
    return sampling.class_weight_summary(six_label_comments(spark, sf_dir)).withColumn(
        "weight", F.round("weight", 6))


# --- features and linear scores ---------------------------------------------

def _tokenised(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "id", model_tokens(F.col("comment_text")).alias("tokens"))


def hashing_tf(spark, sf_dir):
    hashed = features.hashed_counts(_tokenised(spark, sf_dir), "tokens")
    return scoring.vector_entries(hashed, "raw_features", "id").filter(
        "idx IS NOT NULL").withColumnRenamed("value", "tf")


def idf_table(spark, sf_dir):
    return features.idf_table(_tokenised(spark, sf_dir)).withColumn("idf", F.round("idf", 6))


def tfidf_exact(spark, sf_dir):
    return features.tfidf(_tokenised(spark, sf_dir)).select(
        "id", "term", "tf", F.round("idf", 6).alias("idf"), F.round("tfidf", 6).alias("tfidf"))


def sigmoid_scores(spark, sf_dir):
    """Logits from well inside to far outside the clipping range."""
    x = (F.col("value") - 100) * (F.col("event_id") % 13 - 6)
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(sigmoid(x), 9).alias("p"))


def _term_weight(k: int):
    """Weight of a term for label number k: length and first letter, scaled."""
    term = F.col("term")
    return ((F.length(term) * (31 + 2 * k) + F.ascii(term) * (7 + k)) % 101 - 50) / F.lit(5000.0)


def linear_score_tokens(spark, sf_dir):
    docs = _tokenised(spark, sf_dir)
    counts = features.term_counts(docs, keep_empty=True)
    vocabulary = features.frequency_of_counts(counts)
    weights = vocabulary.withColumns(
        {f"w_{x}": _term_weight(k) for k, x in enumerate(LABELS)})
    scores = scoring.linear_scores(counts, weights, intercepts={"toxic": -0.25})
    return scores.select("id", *[F.round(f"prob_{x}", 6).alias(f"prob_{x}") for x in LABELS])


def _head(k: int, size: int = 64):
    return [((j * (17 + 2 * k) + 5 * k) % 101 - 50) / 25.0 for j in range(size)], 0.05 * k


def dense_head_scores(spark, sf_dir):
    heads = {x: _head(k) for k, x in enumerate(LABELS)}
    scored = scoring.dense_head(table(spark, sf_dir, "embeddings"), "embedding", heads, ["vec_id"])
    return scored.withColumns({f"prob_{x}": F.round(f"prob_{x}", 6) for x in LABELS})


QUERIES = {
    "csv_scan": csv_scan,
    "parquet_scan": parquet_scan,
    "partition_pruned_scan": partition_pruned_scan,
    "parquet_roundtrip": parquet_roundtrip,
    "report_csv_roundtrip": report_csv_roundtrip,
    "staged_publish": staged_publish,
    "verify_readback": verify_readback,
    "nested_json_scan": nested_json_scan,
    "posts_with_quarantine": posts_with_quarantine,
    "row_id_of_copies": row_id_of_copies,
    "publish_in_one_pass": publish_in_one_pass,
    "harmonize_class_code": harmonize_class_code,
    "harmonize_graded": harmonize_graded,
    "majority_vote": majority_vote,
    "harmonize_union": harmonize_union,
    "source_breakdown": source_breakdown,
    "label_projection": label_projection,
    "null_counts": null_counts,
    "table_profile": table_profile,
    "clean_text": clean_text_query,
    "tokenize_whitespace": tokenize_whitespace_query,
    "tokenize_regex": tokenize_regex_query,
    "remove_stopwords": remove_stopwords_query,
    "stopword_anti_join": stopword_anti_join,
    "drop_null_text": drop_null_text,
    "drop_empty_clean": drop_empty_clean,
    "validate_comments": validate_comments,
    "admit_messages": admit_messages,
    "lexicon_override": lexicon_override,
    "lexicon_default": lexicon_default,
    "stable_row_id": stable_row_id_query,
    "hash_sample": hash_sample,
    "train_test_split": train_test_split,
    "class_weights": class_weights,
    "class_weight_summary": class_weight_summary,
    "hashing_tf": hashing_tf,
    "idf_table": idf_table,
    "tfidf_exact": tfidf_exact,
    "sigmoid_scores": sigmoid_scores,
    "linear_score_tokens": linear_score_tokens,
    "dense_head_scores": dense_head_scores,
}

_C = "WITH " + sql.COMMENTS + "\n"
_D = "WITH " + sql.DOCUMENTS + "\n"
_LABEL_COLUMNS = ", ".join(LABELS)
_CLASS_LABELS = """CAST({c} IN (0, 1) AS INTEGER) AS toxic, 0 AS severe_toxic,
  CAST({c} = 1 AS INTEGER) AS obscene, 0 AS threat,
  CAST({c} = 1 AS INTEGER) AS insult, CAST({c} = 0 AS INTEGER) AS identity_hate"""
_VOTE_LABELS = """CAST(majority IN ('hatespeech', 'offensive') AS INTEGER) AS toxic,
  0 AS severe_toxic, 0 AS obscene, 0 AS threat,
  CAST(majority = 'offensive' AS INTEGER) AS insult,
  CAST(majority = 'hatespeech' AS INTEGER) AS identity_hate"""
_GRADED_LABELS = """CAST(coalesce(value / 100 >= 0.5, false) AS INTEGER) AS toxic,
  CAST(coalesce(value / 200 >= 0.5, false) AS INTEGER) AS severe_toxic,
  CAST(coalesce(event_type <> 'view' AND value / 50 >= 0.5, false) AS INTEGER) AS obscene,
  CAST(coalesce(value / 150 >= 0.5, false) AS INTEGER) AS threat,
  CAST(coalesce(value / 75 >= 0.5, false) AS INTEGER) AS insult,
  CAST(coalesce(event_type <> 'click' AND value / 90 >= 0.5, false) AS INTEGER)
    AS identity_hate"""
_EVENT_CLASS = "(CASE event_type WHEN 'error' THEN 0 WHEN 'click' THEN 1 ELSE 2 END)"
_TURN_CLASS = "(CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 ELSE 2 END)"
# Three votes: the majority is the value two of them share, else the first.
_VOTES = """,
V AS (SELECT id, comment_text,
  CASE WHEN toxic = 1 THEN 'hatespeech' ELSE 'normal' END AS v1,
  CASE WHEN quality = 0 THEN 'offensive' ELSE 'undecided' END AS v2,
  CASE WHEN lang = 'en' THEN 'normal' ELSE 'hatespeech' END AS v3 FROM D),
O AS (SELECT id, comment_text, CASE WHEN v2 = v3 THEN v2 ELSE v1 END AS majority FROM V)"""
_POSTS = sql.DOCUMENTS + _VOTES
_TOKENS = "T AS (SELECT doc_id AS id, " + sql.model_words("text") + " AS tokens FROM documents)"
_TERMS = _TOKENS + """,
X AS (SELECT id, unnest(tokens) AS term FROM T),
TF AS (SELECT id, term, count(*) AS tf FROM X GROUP BY ALL),
DF AS (SELECT term, count(*) AS df FROM TF GROUP BY term),
I AS (SELECT term, df, CASE WHEN df >= 5 THEN
  ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (df + 1)) ELSE 0.0::DOUBLE END AS idf
  FROM DF)
"""
_MESSAGES = sql.DOCUMENTS + """,
M AS (SELECT 'turn:' || conv_id || ':' || turn AS id,
  CASE WHEN role = 'system' THEN '/' || text ELSE text END AS text FROM conversations
UNION ALL SELECT 'doc:' || id, comment_text FROM D
UNION ALL SELECT 'blank:' || id, CASE WHEN lang = 'en' THEN E' \\n\\t ' END FROM D
  WHERE quality IS NULL)
"""
_STRIPPED = r"trim(text, E' \t\n\x0b\f\r')"
_SPLIT_TEXT = "array_to_string(regexp_split_to_array(comment_text, '\\s+'), ' ')"
_NUMBERED = list(enumerate(LABELS))



def _times(a: str, b: int) -> str:
    """32-bit product."""
    return f"((({a})::UBIGINT * {b}::UBIGINT) & 4294967295::UBIGINT)"


def _turned(a: str, n: int) -> str:
    """32-bit rotation to the left."""
    return f"(((({a}) << {n}) | (({a}) >> {32 - n})) & 4294967295::UBIGINT)"


def _mixed(k: str) -> str:
    return _times(_turned(_times(k, 0xCC9E2D51), 15), 0x1B873593)


# MurmurHash3 (32 bits, seed 42) of words made of a-z, step by step.
_HASHES = """K AS (SELECT DISTINCT unnest(tokens) AS term FROM T),
B AS (SELECT term, length(term) AS n, list_transform(string_split(term, ''),
  lambda c: ascii(c)::UBIGINT) AS b FROM K),
H0 AS (SELECT *, list_reduce(list_transform(generate_series(1, n // 4), lambda i:
  b[4 * i - 3] | (b[4 * i - 2] << 8) | (b[4 * i - 1] << 16) | (b[4 * i] << 24)),
  lambda h, k: (""" + _times(_turned("xor(h, " + _mixed("k") + ")", 13), 5) + """
    + 3864292196::UBIGINT) & 4294967295::UBIGINT, 42::UBIGINT) AS h FROM B),
H1 AS (SELECT *, coalesce(CASE n % 4 WHEN 1 THEN b[n] WHEN 2 THEN b[n - 1] | (b[n] << 8)
  WHEN 3 THEN b[n - 2] | (b[n - 1] << 8) | (b[n] << 16) END, 0::UBIGINT) AS tail FROM H0),
H2 AS (SELECT term, xor(CASE WHEN n % 4 = 0 THEN h ELSE xor(h, """ + _mixed("tail") + """) END,
  n::UBIGINT) AS h FROM H1),
H3 AS (SELECT term, """ + _times("xor(h, (h >> 16))", 0x85EBCA6B) + """ AS h FROM H2),
H4 AS (SELECT term, """ + _times("xor(h, (h >> 13))", 0xC2B2AE35) + """ AS h FROM H3),
H5 AS (SELECT term, xor(h, h >> 16)::BIGINT AS h FROM H4),
HASHED AS (SELECT term, CAST(((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END)
  % 10000 + 10000) % 10000 AS INTEGER) AS idx FROM H5),
X AS (SELECT id, unnest(tokens) AS term FROM T)
"""

ORACLES = {
    "stable_row_id": _D + """SELECT id, md5('+' || comment_text || chr(1) || '+' || source || chr(1)
  || coalesce('+' || quality, '-')) AS row_id FROM D""",
    "hashing_tf": "WITH " + _TOKENS + ", " + _HASHES + """SELECT id, idx, count(*)::DOUBLE AS tf
  FROM X JOIN HASHED USING (term) GROUP BY ALL""",
    "csv_scan": _C + f"SELECT id, comment_text, {_LABEL_COLUMNS} FROM C",
    "parquet_scan": "SELECT doc_id AS id, source, n_chars FROM documents WHERE text IS NOT NULL",
    "partition_pruned_scan": _C + "SELECT * FROM C WHERE toxic = 1",
    "parquet_roundtrip": _C + "SELECT * FROM C",
    "staged_publish": _C + f"SELECT * REPLACE ({sql.clean('comment_text')} AS comment_text) FROM C",
    "verify_readback": """SELECT source, count(*) AS expected, count(*) AS found,
  true AS matches FROM documents GROUP BY source""",
    "posts_with_quarantine": f"""WITH L AS (SELECT doc_id, len(regexp_split_to_array(text, '\\s+')) AS n,
  CASE WHEN doc_id % {CUT_OFF} = 0 THEN 'not_json' WHEN doc_id % {NO_TOKENS} = 0 THEN 'bad_tokens'
    WHEN doc_id % {NO_OBJECT} = 0 THEN 'no_posts' END AS reason FROM documents)
SELECT CASE WHEN reason IS NULL OR reason = 'bad_tokens' THEN CAST(doc_id AS VARCHAR) END AS post_id,
  CASE WHEN reason IS NULL THEN CAST(n AS INTEGER) END AS n_tokens, CASE WHEN reason IS NULL THEN 3 END AS n_votes, reason FROM L""",
    "row_id_of_copies": """WITH R AS (SELECT CASE WHEN doc_id % 3 = 0 THEN 'the same words' ELSE text END AS comment_text,
  CASE WHEN doc_id % 3 = 0 THEN 'copies' ELSE source END AS source FROM documents),
I AS (SELECT *, md5(coalesce('+' || comment_text, '-') || chr(1) || coalesce('+' || source, '-')) AS h FROM R),
N AS (SELECT *, row_number() OVER (PARTITION BY h) - 1 AS k FROM I)
SELECT comment_text, source, CASE WHEN k = 0 THEN h ELSE h || '-' || k END AS id FROM N""",
    "publish_in_one_pass": f"""SELECT *, expected AS found, true AS matches FROM (
  SELECT 'documents' AS source, count(*) AS expected FROM documents WHERE {sql.clean('text')} <> ''
  UNION ALL SELECT 'conversations', count(*) FROM conversations WHERE {sql.clean('text')} <> '') WHERE expected > 0""",
    "nested_json_scan": "WITH " + _POSTS + f"""
SELECT CAST(id AS VARCHAR) AS post_id, {sql.clean(_SPLIT_TEXT)} AS comment_text,
  majority, {_VOTE_LABELS} FROM O""",
    "harmonize_class_code": "SELECT event_id, " + _CLASS_LABELS.replace("{c}", _EVENT_CLASS)
    + " FROM events",
    "harmonize_graded": f"SELECT event_id, {_GRADED_LABELS} FROM events",
    "majority_vote": f"""WITH V AS (SELECT user_id, ts, event_id, CASE event_type
  WHEN 'error' THEN 'hatespeech' WHEN 'click' THEN 'offensive' ELSE event_type END AS vote
  FROM events),
N AS (SELECT user_id, vote, count(*) AS n, min((ts, event_id)) AS first FROM V GROUP BY ALL),
R AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first) AS r FROM N),
W AS (SELECT user_id, vote AS majority, n AS votes FROM R WHERE r = 1)
SELECT user_id, majority, votes, {_VOTE_LABELS} FROM W""",
    "harmonize_union": "WITH " + sql.COMMENTS + _VOTES + f"""
SELECT {sql.clean('comment_text')} AS comment_text, {_LABEL_COLUMNS}, 'documents' AS source FROM C
UNION ALL BY NAME SELECT {sql.clean('text')} AS comment_text,
  {_CLASS_LABELS.replace("{c}", _TURN_CLASS)}, 'conversations' AS source
  FROM conversations WHERE {sql.clean('text')} <> ''
UNION ALL BY NAME SELECT {sql.clean("event_type || ' ' || props")} AS comment_text,
  {_GRADED_LABELS}, 'events' AS source FROM events
UNION ALL BY NAME SELECT {sql.clean('comment_text')} AS comment_text, {_VOTE_LABELS},
  'posts' AS source FROM O WHERE {sql.clean('comment_text')} <> ''""",
    "source_breakdown": "SELECT source, count(*) AS n FROM documents GROUP BY source",
    "label_projection": _C + "SELECT comment_text, toxic::DOUBLE AS label FROM C",
    "null_counts": _D + "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM D"
        for c in ("id", "comment_text", "lang", "source", "n_chars", "quality", "toxic")),
    "table_profile": _D + "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) AS row_count, "
        f"count(*) - count({c}) AS nulls FROM D"
        for c, t in (("id", "bigint"), ("comment_text", "string"), ("lang", "string"),
                     ("source", "string"), ("n_chars", "bigint"), ("quality", "int"),
                     ("toxic", "int"))),
    "clean_text": f"SELECT doc_id AS id, {sql.clean('text')} AS cleaned FROM documents",
    "tokenize_whitespace": r"""SELECT doc_id AS id, array_to_string(regexp_split_to_array(
  rtrim(lower(text), E' \t\n\x0b\f\r'), '\s'), '|') AS tokens FROM documents""",
    "tokenize_regex": "WITH T AS (SELECT doc_id AS id, " + sql.words(sql.clean("text"))
    + """ AS w FROM documents)
SELECT id, array_to_string(w, ' ') AS tokens, CAST(len(w) AS INTEGER) AS n_tokens FROM T""",
    "remove_stopwords": "WITH " + _TOKENS + """
SELECT id, array_to_string(tokens, ' ') AS tokens, CAST(len(tokens) AS INTEGER) AS n_tokens
FROM T""",
    "stopword_anti_join": "WITH W AS (SELECT unnest(" + sql.words(sql.clean("text"))
    + f""") AS word FROM documents)
SELECT word, count(*) AS n FROM W WHERE word NOT IN {sql.STOP_LIST} GROUP BY word""",
    "drop_null_text": _D + "SELECT id, comment_text FROM D",
    "drop_empty_clean": _D + f""", X AS (SELECT id, comment_text FROM D
  UNION ALL SELECT -1 - id, CAST(n_chars AS VARCHAR) FROM D WHERE quality IS NULL),
E AS (SELECT id, {sql.clean("comment_text")} AS comment_text FROM X) SELECT * FROM E WHERE comment_text <> ''""",
    "validate_comments": "WITH " + _MESSAGES + f""", R AS (SELECT id, CASE
  WHEN text IS NULL THEN 'missing' WHEN {_STRIPPED} = '' THEN 'empty'
  WHEN length({_STRIPPED}) > 5000 THEN 'too_long' END AS reason FROM M)
SELECT id, reason, reason IS NULL AS accepted FROM R""",
    "admit_messages": "WITH " + _MESSAGES + f"""SELECT id, text FROM M
  WHERE text IS NOT NULL AND {_STRIPPED} <> '' AND text NOT LIKE '/%'""",
    "lexicon_override": "WITH B AS (SELECT DISTINCT unnest(" + sql.words(sql.clean("text"))
    + f""") AS word FROM benchmark),
H AS (SELECT DISTINCT id FROM (SELECT doc_id AS id,
  unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+')) AS word FROM documents)
  WHERE word IN (SELECT word FROM B WHERE word <> '')),
S AS (SELECT doc_id AS id, doc_id IN (SELECT id FROM H) AS hit,
  """ + ",\n  ".join(f"((doc_id * {a} + {b}) % 1000)::DOUBLE / 1000.0::DOUBLE AS prob_{x}"
                     for x, (a, b) in SCORE_PARAMETERS.items()) + """ FROM documents)
SELECT id, """ + ", ".join(
        (f"(prob_{x} >= {t} OR hit)" if x in ("toxic", "obscene", "insult")
         else f"prob_{x} >= {t}") + f" AS flag_{x}" for x, t in THRESHOLDS.items()) + """,
  CASE WHEN hit AND prob_toxic < 0.5 THEN 'profanity_filter' END AS flagged_by_toxic,
  CAST(NULL AS VARCHAR) AS flagged_by_severe_toxic,
  CASE WHEN hit AND prob_obscene < 0.5 THEN 'profanity_filter' END AS flagged_by_obscene,
  prob_toxic AS prob1_toxic FROM S""",
    "lexicon_default": """WITH H AS (SELECT DISTINCT id FROM (SELECT doc_id AS id,
  unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}_]+')) AS word FROM documents)
  WHERE word IN (""" + ", ".join(f"'{w}'" for w in DEFAULT_LEXICON) + """)),
S AS (SELECT doc_id AS id, doc_id IN (SELECT id FROM H) AS hit,
  """ + ",\n  ".join(f"((doc_id * {a} + {b}) % 1000)::DOUBLE / 1000.0::DOUBLE AS prob_{x}"
                     for x, (a, b) in SCORE_PARAMETERS.items()) + """ FROM documents)
SELECT id, """ + ", ".join(
        (f"(prob_{x} >= {t} OR hit)" if x in ("toxic", "obscene", "insult")
         else f"prob_{x} >= {t}") + f" AS flag_{x}" for x, t in THRESHOLDS.items()) + """,
  CASE WHEN hit AND prob_toxic < 0.5 THEN 'profanity_filter' END AS flagged_by_toxic FROM S""",
    "hash_sample": "SELECT doc_id AS id, text AS comment_text FROM documents WHERE "
    + sql.bucket("doc_id", 10000) + " < 2500",
    "train_test_split": "SELECT doc_id AS id, CASE WHEN " + sql.bucket("doc_id", 100)
    + " < 80 THEN 'train' ELSE 'test' END AS part FROM documents",
    "class_weights": _C + ", W AS (SELECT " + sql.each_label(
        "count(*) FILTER ({L} = 0)::DOUBLE / count(*) FILTER ({L} = 1) AS r_{L}") + """ FROM C)
SELECT id, """ + sql.each_label(
        "round(CASE WHEN {L} = 1 THEN r_{L} ELSE 1.0::DOUBLE END, 6) AS w_{L}") + " FROM C, W",
    "class_weight_summary": _C + sql.per_label("""count(*) FILTER ({L} = 1) AS n_pos,
  count(*) FILTER ({L} = 0) AS n_neg,
  round(count(*) FILTER ({L} = 0)::DOUBLE / count(*) FILTER ({L} = 1), 6) AS weight,
  CASE WHEN count(*) FILTER ({L} = 1) = 0 THEN 'no_positives' ELSE 'ok' END AS status""", "C"),
    "idf_table": "WITH " + _TERMS + "SELECT term, df, round(idf, 6) AS idf FROM I",
    "tfidf_exact": "WITH " + _TERMS + """SELECT id, term, tf, round(idf, 6) AS idf,
  round(tf * idf, 6) AS tfidf FROM TF JOIN I USING (term)""",
    "sigmoid_scores": """SELECT event_id, round(1.0 / (1.0 + exp(-least(greatest(
  (value - 100) * (event_id % 13 - 6), -500.0::DOUBLE), 500.0::DOUBLE))), 9) AS p FROM events""",
    "linear_score_tokens": "WITH " + _TERMS + ", Z AS (SELECT id, " + ",\n  ".join(
        f"sum(tf * ((length(term) * {31 + 2 * k} + ascii(term) * {7 + k}) % 101 - 50)"
        f" / 5000.0::DOUBLE) AS z_{x}" for k, x in _NUMBERED) + """ FROM TF GROUP BY id)
SELECT T.id, """ + ", ".join(
        f"round(1.0 / (1.0 + exp(-(coalesce(z_{x}, 0.0) + {-0.25 if k == 0 else 0.0}))), 6)"
        f" AS prob_{x}" for k, x in _NUMBERED) + " FROM T LEFT JOIN Z ON T.id = Z.id",
    "dense_head_scores": "WITH E AS (SELECT vec_id, " + ",\n  ".join(
        "1.0 / (1.0 + exp(-(list_sum(list_transform(generate_series(0, 63), "
        f"lambda j: embedding[j + 1]::DOUBLE * ((j * {17 + 2 * k} + {5 * k}) % 101 - 50)"
        f" / 25.0::DOUBLE)) + {0.05 * k}))) AS p_{x}" for k, x in _NUMBERED) + """ FROM embeddings)
SELECT vec_id, """ + sql.each_label("round(p_{L}, 6) AS prob_{L}") + ", "
    + sql.each_label("p_{L} >= 0.5 AS flag_{L}") + " FROM E",
}
