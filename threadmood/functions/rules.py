"""Fixed values of the text rules.

Everything here must equal what existing models and reports were built with:
changing a value changes tokens, vocabularies and percentages.
"""

# fixed values: a whitespace-delimited run holding one of these after its first
# character counts as a URL. Case-sensitive.
URL_SUFFIXES = (".com", ".edu", ".gov", ".org", ".net", ".us")

# fixed values: marks that stand alone as tokens and never enter an n-gram. With
# ASCII letters and digits they are also all that survives next to a space.
PUNCTUATION_TOKENS = (".", "!", "?", ":", ";", ",")

# fixed value: how often runs of punctuation are peeled apart
PUNCTUATION_PASSES = 100

# fixed values: the Unicode whitespace of a text-mode regular expression. Spelled
# out because Java's \s is ASCII-only by default and never has U+001C-U+001F.
WHITESPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# fixed values: markers on raw bodies
SARCASM_MARKER = "/s"
QUOTE_PREFIX = "&gt"

# fixed values: the story id is the end of the comment's parent link
STORY_ID_LENGTH = 6
