"""Small default dictionaries. Every operator takes its own list as a parameter."""

from __future__ import annotations

# English function words, the usual short stop list.
STOPWORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now
    """.split()
)

# Contractions that are not regular, as whole words.
WHOLE_WORDS = {
    "can't": "can not",
    "won't": "will not",
    "shan't": "shall not",
    "ain't": "are not",
    "let's": "let us",
    "y'all": "you all",
    "ma'am": "madam",
}

# Contracted words without an apostrophe.
SLANG = {
    "bc": "because",
    "wanna": "want to",
    "gonna": "going to",
    "gotta": "got to",
    "im": "i am",
}

# Regular endings, applied after the whole words.
ENDINGS = {
    "n't": " not",
    "'re": " are",
    "'ve": " have",
    "'ll": " will",
    "'d": " would",
    "'m": " am",
}

# Words after which 's stands for "is"; elsewhere it is a possessive.
IS_HOSTS = ("it", "that", "there", "what", "he", "she", "who", "where", "how", "when", "here")

# Noun lemmas. The odd ones (was, has, does, as, us, its) come from treating every
# token as a noun, which is what the sentiment models were trained on.
SEED_LEMMAS = {
    "admissions": "admission",
    "algorithms": "algorithm",
    "allergies": "allergy",
    "alumni": "alumnus",
    "as": "a",
    "ass": "as",
    "breaks": "break",
    "bs": "b",
    "computers": "computer",
    "connections": "connection",
    "does": "doe",
    "events": "event",
    "fields": "field",
    "folks": "folk",
    "friends": "friend",
    "gives": "give",
    "graduates": "graduate",
    "halls": "hall",
    "hands": "hand",
    "has": "ha",
    "its": "it",
    "makes": "make",
    "meals": "meal",
    "mice": "mouse",
    "offers": "offer",
    "options": "option",
    "pitfalls": "pitfall",
    "places": "place",
    "products": "product",
    "professionals": "professional",
    "programs": "program",
    "rankings": "ranking",
    "ratings": "rating",
    "reactions": "reaction",
    "reports": "report",
    "resources": "resource",
    "scientists": "scientist",
    "spaces": "space",
    "students": "student",
    "things": "thing",
    "us": "u",
    "vegans": "vegan",
    "vegetables": "vegetable",
    "vegetarians": "vegetarian",
    "was": "wa",
    "years": "year",
}
