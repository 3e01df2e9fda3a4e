"""Labels, thresholds and limits shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values -----------------------------------------------------------
# Output contract: label order (also the tie-break order), flag thresholds,
# display names, limits and the default lexicon. Results depend on them.
LABELS = ("toxic", "severe_toxic", "obscene", "threat", "insult", "identity_hate")

THRESHOLDS = {
    "toxic": 0.50,
    "severe_toxic": 0.80,
    "obscene": 0.50,
    "threat": 0.70,
    "insult": 0.50,
    "identity_hate": 0.65,
}

DISPLAY_NAMES = {
    "toxic": "toxic content",
    "severe_toxic": "severely toxic content",
    "obscene": "obscene language",
    "threat": "threatening language",
    "insult": "insults",
    "identity_hate": "identity-based hate speech",
}
NO_CATEGORY_PHRASE = "harmful content"

HIGH_RISK_RATIO = 0.15
HIGH_RISK_MIN_COMMENTS = 50
MAX_COMMENT_CHARS = 5000
NUM_FEATURES = 10_000
MIN_DOC_FREQ = 5
GRADED_CUT = 0.5
MAX_STRIKES = 3
MUTE_MINUTES = 30
VOLUME_BUCKETS = 20
SYNTHETIC_USERS = 1000

LEXICON_LABELS = ("toxic", "obscene", "insult")
LEXICON_MARK = "profanity_filter"
DEFAULT_LEXICON = (
    "fuck", "fucking", "fucked", "fucker", "fucks",
    "shit", "shitting", "bullshit",
    "bitch", "bitches", "bitching",
    "cunt", "cunts",
    "asshole", "assholes", "ass",
    "bastard", "bastards",
    "whore", "whores",
    "slut", "sluts",
    "dick", "dicks", "cock", "cocks",
    "pussy", "pussies",
    "faggot", "faggots", "fag",
    "retard", "retarded",
    "nigger", "nigga",
    "motherfucker", "motherfucking",
    "cocksucker", "dipshit", "dumbass",
    "jackass", "moron", "imbecile",
    "prick", "twat", "wanker",
)
# --- End of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class ModerationConfig:
    """Everything a moderation run may want to change, in one immutable place."""

    labels: tuple[str, ...] = LABELS
    thresholds: dict[str, float] = field(default_factory=lambda: dict(THRESHOLDS))
    high_risk_ratio: float = HIGH_RISK_RATIO
    high_risk_min_comments: int = HIGH_RISK_MIN_COMMENTS
    max_comment_chars: int = MAX_COMMENT_CHARS
    volume_buckets: int = VOLUME_BUCKETS
    num_features: int = NUM_FEATURES
    min_doc_freq: int = MIN_DOC_FREQ
    reg_param: float = 0.01
    elastic_net: float = 0.5
    max_iter: int = 20
    fit_parallelism: int = 2
    fit_tasks: int | None = None  #: partitions of a training table; None: as it was stored
    max_strikes: int = MAX_STRIKES
    mute_minutes: int = MUTE_MINUTES


DEFAULTS = ModerationConfig()
