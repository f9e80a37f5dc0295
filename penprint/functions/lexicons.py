"""Word lists the features count.

Every list is a default for a parameter: callers may pass their own.
"""

# --- Fixed values: they must equal the reference's for right feature values. ---

AI_WORDS = (
    "tapestry", "delve", "testament", "landscape", "realm", "moreover", "furthermore", "however",
    "therefore", "consequently", "noteworthy", "intricate", "comprehensive", "paradigm", "leverage",
    "robust", "seamless", "foster", "holistic", "nuanced", "myriad", "crucial", "essential",
    "paramount", "utilize", "endeavor", "henceforth", "thus", "facilitate", "implement", "optimize",
    "streamline", "synergy", "multifaceted", "exponential", "transformative", "innovative",
    "cutting-edge", "state-of-the-art", "groundbreaking", "revolutionary", "unprecedented",
    "unparalleled", "burgeoning", "proliferation", "encompasses", "necessitates", "underscores",
    "exemplifies", "substantiate", "elucidate", "ascertain", "epitomize", "meticulous", "pivotal",
    "integral", "salient", "quintessential", "plethora", "gamut", "spectrum", "array", "nexus",
    "catalyst", "impetus", "propensity", "proclivity", "disposition",
)

CONJUNCTIONS = ("and", "but", "or", "so", "because", "although", "however")

TRANSITIONS = (
    "however", "therefore", "furthermore", "moreover", "consequently", "nevertheless", "nonetheless",
)

PRONOUNS = ("i", "me", "my", "mine", "we", "us", "our", "you", "your")

BE_FORMS = ("is", "are", "was", "were", "been", "being")

PUNCTUATION = ".,;:!?"

# --- End of fixed values. ---

# A missing comma in the original list joins two words, so that neither counts.
_FUSED = ("thus", "facilitate")


def ai_words(compat: bool = False) -> tuple[str, ...]:
    """The AI word list; ``compat`` keeps the two words that the original list joins by accident."""
    if not compat:
        return AI_WORDS
    return tuple(w for w in AI_WORDS if w not in _FUSED) + ("".join(_FUSED),)
