"""Quality rules: a short-circuit cascade, ordered by rejection per cost.

DataFrame functions only. A rule is a boolean column that rejects a document.
``order`` measures each rule on a bounded sample (the time of a pass that
evaluates it, less that of an empty pass, and the share it rejects) and sorts by
rejections per second; ``verdict`` nests the rules into one CASE, so that a
document that an early rule rejects never pays for the later ones. The order
changes the cost and which rule is named, never which documents are kept.

Words are cut at ASCII white space, everything else belongs to a word.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideguard.llm.common import table
from tideguard.session import store

BLANK = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
WINDOW = 5
SAMPLE = 2000  # rows that costs and selectivities are measured on


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def _count_of(text: Column, run: str) -> Column:
    """How many characters of ``text`` lie in matches of the pattern ``run``."""
    return F.length(text) - F.length(F.regexp_replace(text, run, ""))


def words_of(text: Column) -> Column:
    body = F.btrim(text, F.lit(BLANK))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[\x20\x09-\x0D]+"))


def measured(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long).

    A null text counts as empty. Windows of five words are compared by 64-bit
    hashes inside the row, nothing is shuffled: a document whose windows are all
    different (one hash set) skips the sort that finds the repeated ones, and
    the sort is n log n for the longest text too.
    """
    own = documents.columns
    body = F.coalesce(F.col(text), F.lit(""))
    df = documents.withColumn("_body", body)
    df = df.withColumn("_words", words_of(F.col("_body")))
    n = F.size("_words")
    # Each step below is a projection of its own, so that an array is made once per row.
    df = df.withColumn("_n", n).withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    window = lambda h, i: F.xxhash64(h, *[F.get("_hashes", i + j) for j in range(1, WINDOW)])
    df = df.withColumn("_windows", F.when(
        F.col("_n") >= WINDOW, F.transform(F.slice("_hashes", 1, F.greatest(F.col("_n") - (WINDOW - 1), F.lit(1))), window))
        .otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_placed", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    last = F.size("_placed") - 1
    equal = lambda i, k: F.get("_placed", i)["h"] == F.get("_placed", i + k)["h"]
    df = df.withColumn("_last", last)
    twice = F.filter("_placed", lambda x, i: ((i > 0) & equal(i, -1)) | ((i < F.col("_last")) & equal(i, 1)))
    df = df.withColumn("_starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate("_starts", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                          lambda a, x: F.struct((a["n"] + F.lit(WINDOW) - F.greatest(F.lit(0), a["end"] - x)).alias("n"),
                                                (x + F.lit(WINDOW)).alias("end")))["n"]
    lines = F.filter(F.split("_body", "\n"), lambda line: F.btrim(line, F.lit(BLANK)) != "")
    df = df.withColumn("_lines", lines)
    return df.select(
        *[c for c in own if c not in MEASURES],
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _count_of(F.col("_body"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_rules(text: str = "text", is_measured: bool = False) -> list[Rule]:
    """Rules on the text alone; thresholds are shares of its characters or words.

    ``is_measured``: the columns of ``measured`` are there and are used.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    if is_measured:
        n, chars, symbols = F.col("n_words"), F.col("word_chars"), F.col("n_symbols")
    else:
        n, chars, symbols = F.regexp_count(body, F.lit(WORD)), _count_of(body, WORD), _count_of(body, SYMBOLS)
    return [
        Rule("too_short", n < 10),
        Rule("symbols", 100 * symbols > 8 * chars),
        Rule("capitals", 100 * _count_of(body, "[A-Z]+") > 40 * chars),
        Rule("exclamations", 100 * _count_of(body, "!+") > 8 * chars),
        Rule("word_length", (chars > 15 * n) | (chars < 2 * n)),
        Rule("digits", 100 * _count_of(body, "[0-9]+") > 30 * chars),
    ]


def sample_of(documents: DataFrame, rows: int, key: str) -> DataFrame:
    """At most ``rows`` rows: those with the smallest hashes of the key.

    Only the hashes are put in order, the texts are not moved.
    """
    h = F.xxhash64(key)
    least = documents.select(h.alias("h")).orderBy("h").limit(rows).collect()
    return documents.where(h <= least[-1]["h"] if least else F.lit(False)).limit(rows)


def order(documents: DataFrame, rules: list[Rule], rows: int = SAMPLE, key: str = "doc_id") -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected), most rejections per second first; ties by name.

    ``rows`` bounds the sample. A null verdict does not reject. On an empty
    table the rules come by name.
    """
    kept = store(sample_of(documents, rows, key), "rule-sample")

    def passes(column: Column) -> tuple[float, float]:
        best, share = float("inf"), 0.0
        for _ in range(2):
            start = time.perf_counter()
            share = kept.df.agg(F.avg(F.coalesce(column, F.lit(False)).cast("int"))).first()[0] or 0.0
            best = min(best, time.perf_counter() - start)
        return best, share

    some = next((c for c in documents.columns if c != key), key)
    empty = passes(F.col(some).isNull())[0]
    found = [(rule, *passes(rule.rejects)) for rule in rules]
    kept.discard()
    found = [(rule, max(seconds - empty, 1e-4), share) for rule, seconds, share in found]
    return sorted(found, key=lambda x: (-x[2] / x[1], x[0].name))


def verdict(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects, or null: evaluated in order, and no further."""
    column = F.lit(None).cast("string")
    for rule in reversed(rules):
        column = F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name)).otherwise(column)
    return column


def cascade(documents: DataFrame, rules: list[Rule] | None = None, rows: int = SAMPLE,
            key: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with rejected_by: the first rule, in the measured order, that rejects a row.

    Defined results: a null text counts as empty (too short); ties and repeated
    rows are judged alike; an empty table stays empty; other columns pass
    unchanged, but an own column rejected_by is replaced.
    """
    rules = text_rules(text) if rules is None else rules
    ranked = [rule for rule, *_ in order(documents, rules, rows, key)]
    return documents.withColumn("rejected_by", verdict(ranked))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: measures, base rule and the cascade's verdict for every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = text_rules(is_measured=True)
    ranked = [rule for rule, *_ in order(measured(sample_of(documents, SAMPLE, "doc_id")), rules, SAMPLE)]
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (measured(documents).withColumn("base_failed", base)
            .withColumn("kept", F.when(F.col("base_failed"), False).otherwise(verdict(ranked).isNull()))
            .select("doc_id", *MEASURES, "base_failed", "kept"))


ORACLE = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
    SELECT doc_id, p, array_to_string(ws[p : p + 4], ' ') AS gram
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS p FROM d WHERE len(ws) >= 5)),
r AS (
    SELECT doc_id, count(DISTINCT p + k) AS n
    FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g), range(5) AS t(k)
    WHERE c > 1 GROUP BY doc_id),
l AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n
    FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
    SELECT d.doc_id, len(ws)::BIGINT AS n_words,
           length(array_to_string(ws, ''))::BIGINT AS word_chars,
           length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
           length(regexp_replace(body, '[^A-Z]', '', 'g')) AS capitals,
           length(regexp_replace(body, '[^!]', '', 'g')) AS exclamations,
           length(regexp_replace(body, '[^0-9]', '', 'g')) AS digits
    FROM d LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 8 * word_chars OR 100 * capitals > 40 * word_chars
            OR 100 * exclamations > 8 * word_chars OR word_chars > 15 * n_words
            OR word_chars < 2 * n_words OR 100 * digits > 30 * word_chars) AS kept
FROM b
"""
