"""SQL building blocks of the oracle queries (DuckDB dialect)."""

from __future__ import annotations

from tideguard.config import LABELS, THRESHOLDS
from tideguard.functions.text import STOP_WORDS
from tideguard.plans.fixtures import SCORE_PARAMETERS


def _lines(items) -> str:
    return ",\n  ".join(items)


def each_label(pattern: str) -> str:
    """The pattern once per label, as a comma list; ``{L}`` is the label."""
    return _lines(pattern.replace("{L}", x) for x in LABELS)


PREDICTIONS = "P0 AS (SELECT event_id AS id, user_id, ts, event_type, " \
    "event_type || ' ' || props AS comment_text,\n  " + _lines(
        f"((event_id * {a} + {b}) % 1000)::DOUBLE / 1000.0::DOUBLE"
        f" * ((user_id % 5 + 1)::DOUBLE / 5.0::DOUBLE) AS prob_{x}"
        for x, (a, b) in SCORE_PARAMETERS.items()) + " FROM events),\n" \
    "P AS (SELECT *,\n  " + each_label(
        "CASE WHEN prob_{L} >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pred_{L}") \
    + ",\n  CAST(event_type = 'error' AS INTEGER) AS toxic,\n  " + _lines(
        f"CAST((event_id + {k}) % 7 = 0 AS INTEGER) AS {x}"
        for k, x in enumerate(LABELS) if k).replace("event_id", "id") + " FROM P0)"

FLAGS = PREDICTIONS + ",\nF0 AS (SELECT *,\n  " + _lines(
    f"prob_{x} >= {THRESHOLDS[x]} AS flag_{x}" for x in LABELS) + " FROM P),\n" \
    "F AS (SELECT *, " + " + ".join(f"flag_{x}::INTEGER" for x in LABELS) \
    + " AS flagged_label_count, " + " + ".join(f"flag_{x}::INTEGER" for x in LABELS) \
    + " > 0 AS any_flagged FROM F0)"

DOCUMENTS = """D AS (SELECT d.doc_id AS id, d.text AS comment_text, d.lang, d.source,
  d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"""

COMMENTS = DOCUMENTS + """,
C AS (SELECT id, comment_text, coalesce(toxic, 0) AS toxic,
  CAST(coalesce(toxic = 1 AND quality = 0, false) AS INTEGER) AS severe_toxic,
  CAST(coalesce(quality = 0, false) AS INTEGER) AS obscene,
  CAST((id + 3) % 7 = 0 AS INTEGER) AS threat,
  CAST((id + 4) % 7 = 0 AS INTEGER) AS insult,
  CAST((id + 5) % 7 = 0 AS INTEGER) AS identity_hate, source FROM D)"""


def clean(text: str) -> str:
    """The cleaning rule, one step after the other."""
    return (f"trim(regexp_replace(regexp_replace(regexp_replace(lower({text}), "
            r"'http\S+', '', 'g'), '[^a-zA-Z\s]', ' ', 'g'), '\s+', ' ', 'g'))")


def words(cleaned: str) -> str:
    """Tokens of cleaned text."""
    return f"list_filter(string_split({cleaned}, ' '), lambda t: t <> '')"


STOP_LIST = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + ")"


def model_words(text: str) -> str:
    """Tokens the models see: cleaned, cut, stop words out."""
    return f"list_filter({words(clean(text))}, lambda t: t NOT IN {STOP_LIST})"


def bucket(key: str, n: int) -> str:
    return f"((({key} % 2147483648) * 2654435761) % 4294967296) * {n} // 4294967296"


def first_max(pattern: str) -> tuple[str, str]:
    """(name of the largest, largest); ties to the earlier label."""
    columns = [pattern.replace("{L}", x) for x in LABELS]
    top = f"greatest({', '.join(columns)})"
    cases = " ".join(f"WHEN {c} = {top} THEN '{x}'" for c, x in zip(columns, LABELS))
    return f"CASE {cases} END", top


def per_label(select: str, source: str) -> str:
    """One SELECT per label, stacked."""
    return "\nUNION ALL ".join(
        "SELECT '" + x + "' AS label, " + select.replace("{L}", x) + f" FROM {source}"
        for x in LABELS)


RISK = "toxicity_ratio > 0.15 AND total_comments >= 50"

USERS = FLAGS + """,
U0 AS (SELECT user_id, count(*) AS total_comments,
  CAST(sum(any_flagged::INTEGER) AS BIGINT) AS flagged_count,
  """ + each_label("CAST(sum(flag_{L}::INTEGER) AS BIGINT) AS {L}_count") + """
  FROM F GROUP BY user_id),
U AS (SELECT user_id, total_comments, flagged_count,
  flagged_count::DOUBLE / total_comments AS toxicity_ratio,
  """ + first_max("{L}_count")[0] + """ AS top_label,
  """ + each_label("{L}_count") + " FROM U0)"
