"""Fixed values.

Everything in the first block must keep these exact values for results to
match the behaviour being rebuilt (labels, thresholds, key lists, formats,
retention horizons).  The second block holds the parameters of our own
lexicon scorer; they are tunable, not facts.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Pipeline semantics.
# --------------------------------------------------------------------------

# Sentiment labels in the order the dashboard lists them.
LABELS = ("Positive", "Negative", "Neutral")

# Compound score thresholds: >= 0.05 Positive, <= -0.05 Negative, else Neutral.
POSITIVE_THRESHOLD = 0.05
NEGATIVE_THRESHOLD = -0.05

# Topics of raw and of scored messages.
NEWS_TOPIC = "financial-news"
SCORED_TOPIC = "financial-news-sentiment"

# Country codes in fetch order (their position is the first-wins order of D1).
COUNTRIES = ("us", "cn", "jp", "kr", "gb", "de", "fr", "it", "es", "nl", "ch")

# Keys a scored message must carry to be served or stored.
REQUIRED_KEYS = ("title", "source", "publishedAt", "sentiment", "confidence", "link")

# History column order on disk.
HISTORY_COLUMNS = ("title", "source", "publishedAt", "sentiment", "confidence", "link")

# Default when an article's source carries no name.
UNKNOWN_SOURCE = "Unknown Source"

# Incoming ISO-8601 timestamp and the display format it is rewritten to.
# Parsing accepts one- or two-digit fields, as strptime's %m/%d/%H/%M/%S do.
ISO_INPUT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_PARSE_PATTERN = "yyyy-M-d'T'H:m:s'Z'"
DISPLAY_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Stream and retention constants.
WATERMARK_DELAY = "10 minutes"
RAW_RETENTION = "7 days"
HISTORY_DAYS = 365                # days of history that expiry keeps
SCORED_RETENTION = "30 minutes"
DEDUPE_DELAY = "7 days"  # D2 in stream form keeps keys as long as raw retention

# Latest view: valid messages with index < 30, then the first valid one after.
LATEST_CAP = 30

# Status of a usable headline API response.
STATUS_OK = "ok"

# Articles per landed response page.
PAGE_SIZE = 30

# Confidence rounding (stored) and card formatting (displayed).
STORED_DECIMALS = 3
CARD_DECIMALS = 2

# --------------------------------------------------------------------------
# Parameters of our lexicon scorer (not derivable from the pipeline).
# --------------------------------------------------------------------------

# Token pattern (letters of any script); keeps in-word apostrophes,
# straight or curly.  Scorer tables hold both spellings of such words.
TOKEN_PATTERN = "\\p{L}+(?:['’]\\p{L}+)*"

# Added to (or, for dampeners, taken from) the magnitude of a valence that
# follows a booster word at distance 1, 2 or 3, times the factor of the distance.
BOOSTER_INCREMENT = "0.293"
BOOSTER_DAMPING = ("1", "0.95", "0.9")
# Valences before the last contrast word count for less, those after for more.
CONTRAST_WORDS = ("but", "however", "aber", "jedoch", "mais", "cependant", "pero")
CONTRAST_BEFORE, CONTRAST_AFTER = "0.5", "1.5"
# Each exclamation mark (up to the limit) adds to the magnitude of the sum.
EXCLAMATION_INCREMENT, EXCLAMATION_LIMIT = "0.292", 4
# Added to the magnitude of a capitalised word's valence when not all words are.
CAPITALS_INCREMENT = "0.733"
# Multiplier for a valence with a negation word among the 3 preceding tokens.
NEGATION_SCALAR = "-0.74"
NEGATION_WINDOW = 3
# Normalisation: compound = s / sqrt(s*s + ALPHA).
NORMALIZATION_ALPHA = 15.0

# Default lexicon: token -> valence.  The words are common ones of business headlines, put by hand into
# five steps of strength, half a point apart; a word has the value of its step.
LEXICON_STEPS = {
    "3.0": (
        "best excellent great love successful wonderful"),
    "2.5": (
        "award confidence happy optimism optimistic positive praise success thrive thrives win winning wins "
        "won"),
    "2.0": (
        "benefit benefits better boom booming bullish confident free good hope hopeful improve improved "
        "improvement improves innovative nice opportunities opportunity outperform outperforms profit "
        "profitable profits rallied rallies rally safe soar soared soars stronger strongest surge surged "
        "surges upbeat welcome"),
    "1.5": (
        "agree boost boosted boosts fair gain gained gains grow growing grows growth like recover recovers "
        "recovery robust secure solid strong upgrade upgraded"),
    "1.0": (
        "beat beats record rise rises rising rose stable"),
    "-3.0": (
        "awful crisis dead death fraud hate kill killed scam terrible war worst worthless"),
    "-2.5": (
        "angry bad bankrupt bankruptcy collapse collapsed crash crashed fail failed fails failure hurt idiot "
        "negative pain recession scandal stupid threat threats ugly useless"),
    "-2.0": (
        "attack bearish dangerous disappointed disappointing fear fears junk layoff layoffs loss losses "
        "pessimistic plunge plunged plunges poor sad slump slumps trash weak weaker weakness worse wrong"),
    "-1.5": (
        "debt default downgrade downgraded fined lawsuit lose losing lost problem problems risky sanction "
        "sanctions uncertain uncertainty warn warning warns"),
    "-1.0": (
        "concern concerns cut cuts decline declined declines drop dropped drops fall falls fell inflation "
        "risk risks tariff tariffs volatile"),
}
DEFAULT_LEXICON = {word: value for value, words in LEXICON_STEPS.items() for word in words.split()}

# The same words, each with a valence of its own to a tenth (-4..+4).  Set by hand from general knowledge of
# such lexicons (the original's is that of Hutto & Gilbert 2014); not checked against a published list.
GRADED_LEXICON = {
    # positive
    "best": "3.2", "better": "1.9", "good": "1.9", "great": "3.1", "excellent": "3.2",
    "strong": "1.7", "stronger": "1.8", "strongest": "2.2", "gain": "1.6", "gains": "1.6",
    "gained": "1.5", "growth": "1.6", "grow": "1.4", "grows": "1.4", "growing": "1.4",
    "profit": "1.8", "profits": "1.8", "profitable": "2.0", "rise": "1.1", "rises": "1.1",
    "rising": "1.1", "rose": "1.0", "surge": "1.8", "surged": "1.8", "surges": "1.8",
    "soar": "2.0", "soared": "2.0", "soars": "2.0", "record": "1.2", "boost": "1.7",
    "boosts": "1.7", "boosted": "1.7", "beat": "1.2", "beats": "1.2", "win": "2.7",
    "wins": "2.7", "winning": "2.4", "won": "2.5", "success": "2.7", "successful": "2.8",
    "positive": "2.6", "optimistic": "2.3", "optimism": "2.4", "upbeat": "2.1", "rally": "1.8",
    "rallied": "1.8", "rallies": "1.8", "recover": "1.7", "recovers": "1.7", "recovery": "1.6",
    "improve": "1.9", "improved": "2.0", "improves": "1.9", "improvement": "2.0", "free": "2.2",
    "love": "3.2", "like": "1.5", "happy": "2.7", "hope": "1.9", "hopeful": "2.2",
    "safe": "1.9", "secure": "1.4", "stable": "1.2", "bullish": "2.0", "outperform": "1.8",
    "outperforms": "1.8", "upgrade": "1.6", "upgraded": "1.6", "benefit": "2.0", "benefits": "1.9",
    "opportunity": "1.8", "opportunities": "1.8", "innovative": "1.9", "confident": "2.2",
    "confidence": "2.3", "robust": "1.5", "solid": "1.3", "thrive": "2.4", "thrives": "2.4",
    "booming": "2.1", "boom": "1.9", "welcome": "2.0", "praise": "2.5",
    "agree": "1.5", "award": "2.5", "wonderful": "3.0", "nice": "1.8", "fair": "1.3",
    # negative
    "bad": "-2.5", "worst": "-3.1", "worse": "-2.1", "poor": "-2.1", "weak": "-1.9",
    "weaker": "-1.9", "loss": "-1.8", "losses": "-1.8", "lose": "-1.7", "losing": "-1.6",
    "lost": "-1.4", "fall": "-1.0", "falls": "-1.0", "fell": "-1.0", "drop": "-1.1",
    "drops": "-1.1", "dropped": "-1.1", "decline": "-1.2", "declines": "-1.2", "declined": "-1.2",
    "plunge": "-2.0", "plunged": "-2.0", "plunges": "-2.0", "crash": "-2.6", "crashed": "-2.6",
    "slump": "-1.8", "slumps": "-1.8", "fear": "-2.2", "fears": "-2.2", "risk": "-1.1",
    "risks": "-1.1", "risky": "-1.5", "crisis": "-3.0", "debt": "-1.5", "default": "-1.6",
    "bankrupt": "-2.6", "bankruptcy": "-2.6", "fraud": "-2.9", "scandal": "-2.4", "lawsuit": "-1.6",
    "fined": "-1.7", "layoff": "-1.9", "layoffs": "-1.9", "cut": "-1.1", "cuts": "-1.1",
    "warning": "-1.4", "warn": "-1.3", "warns": "-1.3", "negative": "-2.6", "pessimistic": "-2.0",
    "bearish": "-2.0", "downgrade": "-1.6", "downgraded": "-1.6", "worthless": "-2.9",
    "fail": "-2.5", "fails": "-2.5", "failed": "-2.3", "failure": "-2.7", "problem": "-1.6",
    "problems": "-1.7", "concern": "-1.2", "concerns": "-1.2", "volatile": "-1.1",
    "uncertainty": "-1.4", "uncertain": "-1.3", "recession": "-2.4", "inflation": "-1.0",
    "hate": "-2.9", "angry": "-2.4", "terrible": "-2.9", "awful": "-2.8", "wrong": "-2.1",
    "threat": "-2.3", "threats": "-2.3", "war": "-2.9", "attack": "-2.2", "dead": "-3.2",
    "death": "-2.9", "kill": "-3.5", "killed": "-3.4", "sad": "-2.1", "pain": "-2.4",
    "hurt": "-2.3", "ugly": "-2.3", "useless": "-2.4", "scam": "-2.8", "trash": "-2.0",
    "junk": "-1.8", "dangerous": "-2.1", "stupid": "-2.4", "idiot": "-2.7", "collapse": "-2.4",
    "collapsed": "-2.4", "sanction": "-1.5", "sanctions": "-1.5", "tariff": "-0.8",
    "tariffs": "-0.8", "disappointing": "-2.2", "disappointed": "-2.0", "weakness": "-1.8",
}

# Words that strengthen (positive increment) or soften (negative increment)
# the valence of a word that follows them within 3 tokens.
DEFAULT_BOOSTERS = {
    "very": BOOSTER_INCREMENT, "extremely": BOOSTER_INCREMENT, "really": BOOSTER_INCREMENT,
    "highly": BOOSTER_INCREMENT, "hugely": BOOSTER_INCREMENT, "incredibly": BOOSTER_INCREMENT,
    "so": BOOSTER_INCREMENT, "most": BOOSTER_INCREMENT, "more": BOOSTER_INCREMENT,
    "totally": BOOSTER_INCREMENT, "completely": BOOSTER_INCREMENT, "absolutely": BOOSTER_INCREMENT,
    "sharply": BOOSTER_INCREMENT, "deeply": BOOSTER_INCREMENT, "strongly": BOOSTER_INCREMENT,
    "less": "-" + BOOSTER_INCREMENT, "slightly": "-" + BOOSTER_INCREMENT,
    "barely": "-" + BOOSTER_INCREMENT, "hardly": "-" + BOOSTER_INCREMENT,
    "somewhat": "-" + BOOSTER_INCREMENT, "marginally": "-" + BOOSTER_INCREMENT,
    "partly": "-" + BOOSTER_INCREMENT, "little": "-" + BOOSTER_INCREMENT,
}

# Words that flip the valence of a word within the next 3 tokens.
DEFAULT_NEGATIONS = (
    "not", "no", "never", "none", "nobody", "nothing", "neither", "nor", "nowhere",
    "cannot", "without", "ain't", "aren't", "can't", "couldn't", "didn't", "doesn't",
    "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't", "needn't",
    "shan't", "shouldn't", "wasn't", "weren't", "won't", "wouldn't", "dont", "doesnt",
    "didnt", "isnt", "cant", "wont", "nicht", "kein", "keine", "pas", "jamais", "nunca",
)
