"""The text rules run one by one, with no shortcut: the yardstick for the engine."""

import re

# fixed values: the rules in order
_URL = r"(?:(?:https?|file|ftp)://)?\S+(?:\.com|\.edu|\.gov|\.org|\.net|\.us)\\*\S*"
_EDGES = [(r"(\w)(\W) ", r"\1 \2 "), (r" (\W)(\w)", r" \1 \2"), (" +", " ")]
_PASS = [(r" (\W)(\W)", r" \1 \2 "), (r"(\W)(\W) ", r"\1 \2 "), (" +", " ")]
PLAIN = [("[\n\t]", " "), (rf"\[(.*)\]\({_URL}\)", r"\1"), (_URL, "")]
PUNCTUATION = [
    (r"[^\x20-\x7E]", ""),
    (r"(\w)(\W)$", r"\1 \2"),
    (r"^(\W)(\w)", r"\1 \2"),
    (r"^(\W)$", r"\1 "),
    (r"(\W)(\W)$", r"\1 \2"),
    (r"^(\W)(\W)", r"\1 \2"),
    *_EDGES,
    *(_PASS * 100),
    *_EDGES,
]
SPECIALS = [(" [^a-zA-Z0-9.,:;?!]", " "), ("[^a-zA-Z0-9.,:;?!] ", " "), (" +", " ")]
MARKS = set(".!?:;,")


def _compiled(rules):
    return [(re.compile(pattern), replacement) for pattern, replacement in rules]


_PLAIN, _PUNCTUATION, _SPECIALS = map(_compiled, (PLAIN, PUNCTUATION, SPECIALS))


def run(rules, text):
    for pattern, replacement in rules:
        text = pattern.sub(replacement, text)
    return text


def without_urls(body):
    return run(_PLAIN, body)


def punctuated(body):
    return run(_PUNCTUATION, without_urls(body).lower())


def cleaned(body):
    return run(_SPECIALS, punctuated(body)).strip()


def sanitized(body):
    words = cleaned(body).split(" ")
    grams = [w for w in words if w and w not in MARKS]
    for n in (2, 3):
        for start in range(len(words) - n + 1):
            window = words[start : start + n]
            if not MARKS.intersection(window):
                grams.append("_".join(window))
    return grams
