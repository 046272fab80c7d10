"""Fixed values of rule-based sentiment scoring (Hutto & Gilbert 2014; word lists published under the MIT licence)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Score normalisation: s / sqrt(s^2 + NORM).
NORM = 15

# Emphasis of an all-caps word in a mixed-case text.
CAPS_BOOST = 0.733

# A negated valence is multiplied by this.
NEGATION_FACTOR = -0.74

# Damping of a booster one, two, three words before the scored word.
BOOSTER_DAMPING = (1.0, 0.95, 0.9)

# Weight of words before / after the first "but".
BEFORE_BUT, AFTER_BUT = 0.5, 1.5

# Punctuation emphasis: per "!" (at most four count), per "?" (two or three), and for more "?".
EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
QUESTION, MAX_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96

# White space: as a regex class between tokens, as a list where it is trimmed from both ends.
SPACE_CLASS = r"\s\x0b\x1c-\x1f\x85\p{Z}"
SPACES = (
    " \t\n\r\f\x0b\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# ASCII punctuation trimmed from both ends of a token, unless at most two characters would remain.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
KEEP_SHORT = 2

# Label cut points on the compound score.
POSITIVE_FROM, NEGATIVE_TO = 0.05, -0.05

NEGATIONS = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "ain't", "aren't", "can't",
    "couldn't", "daren't", "didn't", "doesn't", "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt",
    "neither", "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't", "neednt", "needn't",
    "never", "none", "nope", "nor", "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "uhuh",
    "wasnt", "werent", "oughtn't", "shan't", "shouldn't", "uh-uh", "wasn't", "weren't", "without", "wont",
    "wouldnt", "won't", "wouldn't", "rarely", "seldom", "despite",
)

_UP = (
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably", "decidedly", "deeply",
    "effing", "enormous", "enormously", "entirely", "especially", "exceptional", "exceptionally", "extreme",
    "extremely", "fabulously", "flipping", "flippin", "frackin", "fracking", "fricking", "frickin", "frigging",
    "friggin", "fully", "fuckin", "fucking", "fuggin", "fugging", "greatly", "hella", "highly", "hugely",
    "incredible", "incredibly", "intensely", "major", "majorly", "more", "most", "particularly", "purely",
    "quite", "really", "remarkably", "so", "substantially", "thoroughly", "total", "totally", "tremendous",
    "tremendously", "uber", "unbelievably", "unusually", "utter", "utterly", "very",
)
_DOWN = (
    "almost", "barely", "hardly", "kinda", "kindof", "kind-of", "less", "little",
    "marginal", "marginally", "occasional", "occasionally", "partly", "scarce", "scarcely", "slight", "slightly",
    "somewhat", "sorta", "sortof", "sort-of",
)

BOOSTERS = {**{w: 0.293 for w in _UP}, **{w: -0.293 for w in _DOWN}}


@dataclass(frozen=True)
class Phrases:
    """Rules on several words."""

    # This word before a lexicon word negates it, unless one of the second list stands before it.
    least: str | None = "least"
    least_after: tuple[str, ...] = ("at", "very")
    # A negation that strengthens when one of these words follows it.
    strengthens: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {"never": ("so", "this")})
    # A negation that does nothing when one of these words follows it.
    idle: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {"without": ("doubt",)})
    # This lexicon word carries nothing before another one, and negates up to two words on, or three over these.
    no: str = "no"
    no_over: tuple[str, ...] = ("or", "nor")
    # The first word carries nothing before the second.
    kind: tuple[str, str] = ("kind", "of")
    # Phrases with a valence of their own, wherever one of their words is a lexicon word.
    idioms: Mapping[str, float] = field(
        default_factory=lambda: {
            "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5,
            "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9,
        }
    )
    # Boosters of two words, added as they are.
    boosters: Mapping[str, float] = field(default_factory=lambda: {"kind of": -0.293, "sort of": -0.293, "just enough": -0.293})


# A strengthened negation.
NEVER_FACTOR = 1.25
