"""Term counts, document frequencies and TF-IDF.

Two forms: over the exact vocabulary, as joins and aggregates, and hashed into
a fixed number of columns, as ML stages (see ``training``).
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideguard.config import MIN_DOC_FREQ, NUM_FEATURES
from tideguard.functions.rows import one_row_each
from tideguard.operators.joins import HOT_KEY_ROWS, lookup_even


def hashed_counts(df: DataFrame, tokens: str, out: str = "raw_features",
                  num_features: int = NUM_FEATURES) -> DataFrame:
    return HashingTF(inputCol=tokens, outputCol=out, numFeatures=num_features).transform(df)


def term_counts(df: DataFrame, tokens: str = "tokens", key: str = "id",
                keep_empty: bool = False) -> DataFrame:
    """(key, term, tf). A row's tokens share a task, so the map-side combine
    already makes the final rows and only distinct pairs are shuffled.

    ``keep_empty`` gives a row without tokens one NULL term, so that it is
    still scored further on.
    """
    rows = (df.select(key, F.explode_outer(tokens).alias("term")) if keep_empty
            else one_row_each(df, "term", F.col(tokens), key))
    return rows.groupBy(key, "term").agg(F.count("*").alias("tf"))


def document_frequency(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(term, df) straight from the distinct words of each row."""
    return (one_row_each(df, "term", F.array_distinct(F.col(tokens)))
            .groupBy("term").agg(F.count("*").alias("df")))


def frequency_of_counts(counts: DataFrame) -> DataFrame:
    """(term, df) from term counts. It reads ``tf``, so that both uses of the
    counts ask for the same columns and Spark shuffles them only once. For that
    no filter on the term may sink below the counts either, neither one from here
    nor one that a join on the result would add: the NULL term goes by its count."""
    some = F.col("term").isNotNull() & (F.col("tf") > 0)
    return (counts.groupBy("term").agg(F.count_if(some).alias("df")).filter("df > 0")
            .select(F.coalesce("term", F.lit("")).alias("term"), "df"))


def idf(n_rows: Column, df: Column, min_doc_freq: int = MIN_DOC_FREQ) -> Column:
    """ln((N + 1) / (df + 1)); terms in fewer than ``min_doc_freq`` rows weigh 0."""
    return F.when(df >= min_doc_freq, F.log((n_rows + 1) / (df + 1))).otherwise(0.0)


def idf_table(df: DataFrame, tokens: str = "tokens", min_doc_freq: int = MIN_DOC_FREQ,
              frequencies: DataFrame | None = None) -> DataFrame:
    n_rows = df.agg(F.count("*").alias("n")).scalar()
    found = frequencies if frequencies is not None else document_frequency(df, tokens)
    return found.withColumn("idf", idf(n_rows, F.col("df"), min_doc_freq))


def tfidf(df: DataFrame, tokens: str = "tokens", key: str = "id",
          min_doc_freq: int = MIN_DOC_FREQ, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """(key, term, tf, idf, tfidf) over the exact vocabulary."""
    counts = term_counts(df, tokens, key)
    weights = idf_table(df, tokens, min_doc_freq, frequency_of_counts(counts))
    joined = lookup_even(counts, weights, "term", "df", key, hot_rows=hot_rows)
    return joined.select(key, "term", "tf", "idf",
                         (F.col("tf") * F.col("idf")).alias("tfidf"))
