"""Text normalisation as column expressions (no Python in the data path)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .wordlists import ENDINGS, IS_HOSTS, SLANG, WHOLE_WORDS

# White space as the training texts were split on: Unicode spaces and the four separator
# controls, which java.util.regex leaves out of \s even in Unicode mode.
_SPACES = r"(?U)[\s\x1c-\x1f]+"
_URL = r"(?U)http[^\s\x1c-\x1f]+"
_WORD_CHAR = r"[\p{L}\p{N}_]"


@dataclass(frozen=True)
class Profile:
    """One named cleaning recipe."""

    keep: str
    """Punctuation that survives, as the inside of a character class."""
    url: str
    """What a URL becomes."""
    contractions: bool
    """Whether contractions are expanded first."""
    drop_stopwords: bool = False


# Which characters each profile keeps.
PROFILES = {
    "serving": Profile(keep="", url=" ", contractions=True),
    "batch": Profile(keep=r".;:!?\"-", url=" ", contractions=True),
    "training": Profile(keep=r".,;:!?'\"-", url="", contractions=False),
    "emotion": Profile(keep=r".,;:!?'\"-", url="", contractions=False, drop_stopwords=True),
}


def profile(name: str) -> Profile:
    if name not in PROFILES:
        raise ValueError(f"unknown profile {name!r}; known: {', '.join(PROFILES)}")
    return PROFILES[name]


def split_words(col: Column) -> Column:
    """White-space words of a text, none of them empty."""
    return F.filter(F.split(col, _SPACES, -1), lambda w: w != "")


def token_count(col: Column) -> Column:
    """Number of white-space words; 0 for an empty text, null for a null one."""
    return F.when(col.isNotNull(), F.size(split_words(col)))


def clean(col: Column, name: str = "serving", stopwords: Iterable[str] = ()) -> Column:
    """Lower-case a text and blank out URLs and every character the profile does not keep.

    ``stopwords`` matters only to a profile that drops them. Contractions are a separate step
    (:func:`expand_contractions`), since dictionaries differ between corpora.
    """
    p = profile(name)
    # \p{Alnum} is ASCII here. Spaces are junk too, so each run leaves one space behind.
    out = F.regexp_replace(F.regexp_replace(col, _URL, p.url), rf"[^\p{{Alnum}}{p.keep}]+", " ")
    out = F.lower(out)
    if p.drop_stopwords:
        return F.array_join(without_words(F.split(out, " ", -1), ["", *stopwords]), " ")
    return out


def expand_contractions(
    col: Column,
    whole_words: Mapping[str, str] = WHOLE_WORDS,
    endings: Mapping[str, str] = ENDINGS,
    is_hosts: Iterable[str] = IS_HOSTS,
) -> Column:
    """Write contractions out (``they're`` -> ``they are``), curly apostrophes included.

    Texts without an apostrophe pass through, and each rewrite runs only where its letters
    occur. Slang without apostrophes is left to the token dictionary.
    """
    left, right = f"(?<!{_WORD_CHAR})", f"(?!{_WORD_CHAR})"
    rules = [(word, f"(?i){left}{word}{right}", full) for word, full in whole_words.items()]
    rules += [(end, f"(?i)(?<=[a-z]){end}{right}", full) for end, full in endings.items()]
    rules.append(("'s", f"(?i){left}({'|'.join(is_hosts)})'s{right}", "$1 is"))

    def step(text: Column, low: Column, letters: str, pattern: str, full: str) -> Column:
        return let(text, lambda t: F.when(
            low.contains(letters), F.regexp_replace(t, pattern, full)).otherwise(t))

    def rewrite(text: Column, low: Column) -> Column:
        for rule in rules:
            text = step(text, low, *rule)
        return text

    return let(F.replace(col, F.lit("’"), F.lit("'")), lambda text: F.when(
        text.contains("'"), let(F.lower(text), lambda low: rewrite(text, low))
    ).otherwise(text))


def tokens(col: Column) -> Column:
    """Rule tokens of a cleaned text: runs of letters and digits, and single punctuation marks."""
    return F.regexp_extract_all(col, F.lit(r"""[a-z0-9]+|[.,;:!?'"-]"""), F.lit(0))


def without_words(words: Column, listed: Iterable[str]) -> Column:
    """Array without the listed words; order and repeats stay. Lookups hash, they do not scan."""
    listed = list(listed)
    return F.filter(words, lambda w: ~w.isin(listed)) if listed else words


def drop_stopwords(col: Column, stopwords: Iterable[str]) -> Column:
    """A text without the listed words, single spaced."""
    return F.array_join(without_words(split_words(col), stopwords), " ")


def replace_tokens(words: Column, mapping: Mapping[str, str]) -> Column:
    """Replace array elements through a small dictionary without a join or a shuffle.

    The hashed membership test keeps the linear map lookup to the words that are listed. For a
    dictionary of thousands use :func:`pulse.operators.lexicon.apply_lexicon`.
    """
    if not mapping:
        return words
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    keys = list(mapping)
    return F.transform(words, lambda w: F.when(w.isin(keys), pairs[w]).otherwise(w))


def normalize(
    col: Column,
    name: str = "serving",
    lemmas: Mapping[str, str] | None = None,
    stopwords: Iterable[str] = (),
) -> Column:
    """The whole chain: contractions (if the profile wants them), clean, tokens, lemmas, joined."""
    words = dict(lemmas or {})
    if profile(name).contractions:
        col = expand_contractions(col)
        words.update(SLANG)
    return F.array_join(replace_tokens(tokens(clean(col, name, stopwords)), words), " ")
