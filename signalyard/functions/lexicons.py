"""Our own small, versioned word lists.  They stand in for the
third-party sentiment and language libraries of the reference; results
follow the same contract (labels neg/neu/pos, ISO language codes) but do
not claim parity with those libraries."""

LEXICON_VERSION = "1"

# --- fixed values: sentiment lexicon (lower-case, ASCII) ----------------
POSITIVE_WORDS = [
    "good", "great", "excellent", "positive", "gain", "gains", "growth", "strong", "rise",
    "rising", "rally", "profit", "profits", "success", "successful", "improve", "improved",
    "improvement", "benefit", "win", "best", "better", "happy", "optimistic", "boost",
    "recovery", "record", "surge", "favourable", "favorable", "stable", "safe", "love",
    "nice", "wonderful", "up", "bullish", "support", "agree", "thanks",
]
NEGATIVE_WORDS = [
    "bad", "poor", "negative", "loss", "losses", "fall", "falling", "drop", "decline",
    "weak", "crisis", "risk", "risks", "fear", "fears", "worse", "worst", "fail", "failed",
    "failure", "shortage", "drought", "disease", "threat", "war", "conflict", "down",
    "bearish", "crash", "collapse", "problem", "problems", "hate", "sad", "angry", "error",
    "wrong", "damage", "concern", "pessimistic",
]

# --- fixed values: language profiles (stop words, lower-case, ASCII) ----
LANGUAGE_PROFILES = {
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist",
           "nicht", "ein", "eine", "dem", "im", "als", "auch", "werden"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with",
           "by", "as", "this", "are", "at", "from", "be", "have", "not", "but", "which"],
    "es": ["el", "los", "las", "del", "que", "y", "por", "con", "para", "una", "se", "al",
           "lo", "como", "su", "pero", "mas", "esta", "es"],
    "fr": ["le", "les", "des", "du", "et", "qui", "pour", "par", "au", "aux", "une", "est",
           "dans", "sur", "pas", "elle", "avec", "ce", "il", "plus"],
}
# Tie order: the first language in code order wins.
LANGUAGE_ORDER = sorted(LANGUAGE_PROFILES)

# --- fixed values: words under which valences change (lower-case, ASCII) ---
STRONG_WORDS = ["great", "excellent", "best", "wonderful", "love", "surge", "rally", "boost", "crisis", "worst", "war", "crash", "collapse",
                "hate", "disease", "threat"]
MILD_WORDS = ["up", "record", "stable", "safe", "support", "agree", "thanks", "nice", "down", "drop", "error", "concern", "risk", "risks"]
#: Weights: 3 and -3 for strong words, 1 and -1 for mild ones, 2 and -2 for the others.
VALENCES = {w: sign * (3 if w in STRONG_WORDS else 1 if w in MILD_WORDS else 2)
            for sign, words in ((1, POSITIVE_WORDS), (-1, NEGATIVE_WORDS)) for w in words}
NEGATIONS = ["not", "no", "never", "none", "nobody", "nothing", "neither", "nor", "nowhere", "without", "cannot", "hardly", "barely", "scarcely"]
INTENSIFIERS = ["very", "extremely", "highly", "really", "so", "most", "absolutely", "completely", "deeply", "greatly", "incredibly",
                "particularly", "remarkably", "strongly", "totally", "truly"]
DAMPENERS = ["slightly", "somewhat", "fairly", "partly", "little", "marginally", "mildly", "almost", "kind", "sort", "less"]
CONTRASTS = ["but", "however", "yet"]
