"""Comment clean-up and n-grams as native column expressions.

Every function maps a Column to a Column, stays in the JVM and needs no shuffle,
so the whole chain runs inside the scan's stage. Bodies are taken whole.

``clean`` = ``spaces_for_breaks`` -> ``remove_urls`` -> ``lowercase`` ->
``split_punctuation`` -> ``drop_specials``; ``sanitize`` adds the n-grams.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadmood.functions import rules

_SUFFIX = r"\.(?:" + "|".join(s[1:] for s in rules.URL_SUFFIXES) + ")"
_SOLID = f"[^{rules.WHITESPACE}]"
# A URL match always begins at the start of its run of solid characters, and an
# optional scheme in front is covered by the run itself. Anchoring there keeps
# the cost linear in the run instead of quadratic.
_URL_RUN = f"(?<!{_SOLID}){_SOLID}+{_SUFFIX}{_SOLID}*"
_SOLID_RUN = f"{_SOLID}+"

# Classes are listed character by character, and patterns start at the rarest one
# and look behind: java.util.regex then tests a bit set per character of text.
_MARK = "[" + "".join("\\" + c for c in string.punctuation if c != "_") + "]"
_MARK_PAIR_AT_SPACE = rf"{_MARK}(?:{_MARK} |(?<= .){_MARK})"
_SPECIAL = f"[^{string.ascii_letters}{string.digits}{''.join(rules.PUNCTUATION_TOKENS)}]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a name, so ``body`` may use it often and it is computed once.

    Folding no elements hands the start value to the finish function as it is.
    """
    nothing = F.array().cast("array<int>")
    return F.aggregate(nothing, value, lambda bound, _: bound, body)


def _replace(text: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(replacement))


def _single_spaces(text: Column) -> Column:
    return _replace(text, " {2,}", " ")


def spaces_for_breaks(text: Column) -> Column:
    """Newlines and tabs become spaces; a carriage return does not."""
    space = F.lit(" ")
    return F.replace(F.replace(text, F.lit("\n"), space), F.lit("\t"), space)


def _last_index(text: Column, part: str, before: Column) -> Column:
    """Where ``part`` last begins (from 1) among the first ``before`` characters; 0 if nowhere. Linear."""
    head = F.left(text, before)
    at = F.instr(F.reverse(head), part[::-1])
    return F.when(at > 0, F.length(head) - at - len(part) + 2).otherwise(0)


def _link_end(run: Column) -> Column:
    """Of a run of solid characters: where the last "](" before a URL begins, and where its ")" is; else zeros.

    The URL needs a character, then a suffix, and a ")" after it in the same run. So the last
    ")" bounds the suffix, the last suffix before it bounds the "](", and one look from the
    end finds each: no pair of places is tried.
    """

    def opened(closing: Column) -> Column:
        def bracket(suffix: Column) -> Column:
            return F.when(suffix > 3, _last_index(run, "](", suffix - 2)).otherwise(0)

        ends = (_last_index(run, s, closing - 1) for s in rules.URL_SUFFIXES)
        return F.struct(_let(F.greatest(*ends), bracket).alias("open"), closing.alias("close"))

    return _let(_last_index(run, ")", F.length(run)), opened)


def _without_link(text: Column) -> Column:
    """The first "[" of a line opens the link and its last "](url)" closes it; the text between stays.

    The text between is greedy, so there is at most one link in a line.
    """

    def of_line(line: Column) -> Column:
        runs = F.regexp_extract_all(line, F.lit(_SOLID_RUN), F.lit(0))
        links = F.filter(
            F.transform(runs, lambda r: F.struct(r.alias("run"), _link_end(r).alias("at"))), lambda x: x["at"]["open"] > 0
        )

        def cut(link: Column) -> Column:
            # a later run cannot hold this one, or it would be the last link itself
            begin = F.length(line) - F.instr(F.reverse(line), F.reverse(link["run"])) - F.length(link["run"]) + 1
            first, opened = F.instr(line, "["), begin + link["at"]["open"]
            found = F.concat(
                F.left(line, first - 1),
                F.substring(line, first + 1, opened - first - 1),
                F.substring(line, begin + link["at"]["close"] + 1, F.length(line)),
            )
            return F.when((first > 0) & (first < opened), found).otherwise(line)

        return _let(F.try_element_at(links, F.lit(-1)), lambda x: F.when(x.isNull(), line).otherwise(cut(x)))

    return F.array_join(F.transform(F.split(text, "\n"), of_line), "\n")


def remove_urls(text: Column) -> Column:
    """Reduce a markdown link to its text, then delete every run that holds a URL suffix.

    Both need a suffix somewhere; texts without one are only looked through.
    """

    def removed(t: Column) -> Column:
        found = reduce(or_, (t.contains(suffix) for suffix in rules.URL_SUFFIXES))
        plain = F.when(t.contains("]("), _without_link(t)).otherwise(t)
        gone = _replace(plain, _URL_RUN, "")
        return F.when(found, gone).otherwise(t)

    return _let(text, removed)


def lowercase(text: Column) -> Column:
    return F.lower(text)


def strip_non_ascii(text: Column) -> Column:
    """Delete all but the printable ASCII characters, leaving no gap."""
    return _replace(text, r"[^\x20-\x7E]+", "")


def _split_ends(text: Column) -> Column:
    return _replace(_replace(text, r"^\W", "$0 "), r"\W$", " $0")


def _split_word_edges(text: Column) -> Column:
    """Part a mark from its word where it meets a space. ``text`` has no double space."""
    after_word = _replace(text, rf"{_MARK} (?<=\w. )", " $0")
    return _replace(after_word, rf" {_MARK}(?=\w)", "$0 ")


def _peel_once(text: Column) -> Column:
    left = _replace(text, r" (\W)(\W)", " $1 $2 ")
    return _single_spaces(_replace(left, r"(\W)(\W) ", "$1 $2 "))


def _peel_runs(text: Column) -> Column:
    """All passes over runs of marks, idling once a pass has changed nothing.

    A pass that leaves the text alone makes every later pass do the same, so
    stopping there equals running them all.
    """
    start = F.struct(text.alias("now"), F.lit(None).cast("string").alias("before"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(rules.PUNCTUATION_PASSES)),
        start,
        lambda acc, _: F.when(acc["now"] == acc["before"], acc).otherwise(
            F.struct(_peel_once(acc["now"]).alias("now"), acc["now"].alias("before"))
        ),
        lambda acc: acc["now"],
    )


def split_punctuation(text: Column) -> Column:
    """Strip to ASCII, then set marks at word edges and in runs apart by single spaces.

    Marks inside a word stay. Once edges are split, peeling can change the text
    only where two marks in a row touch a space; other rows skip it.
    """
    edges = _split_word_edges(_single_spaces(_split_ends(strip_non_ascii(text))))
    return _let(
        edges,
        lambda t: F.when(
            t.rlike(_MARK_PAIR_AT_SPACE), _split_word_edges(_peel_runs(t))
        ).otherwise(t),
    )


def drop_specials(text: Column) -> Column:
    """Delete other marks (and ``_``) beside a space, once per side, then tidy the spaces."""
    beside = _replace(_replace(text, f" {_SPECIAL}", " "), f"{_SPECIAL} ", " ")
    return F.trim(_single_spaces(beside))


def clean(body: Column) -> Column:
    """The parsed text: tokens, marks included, one space apart."""
    plain = lowercase(remove_urls(spaces_for_breaks(body)))
    return drop_specials(split_punctuation(plain))


def split_words(text: Column) -> Column:
    """Split on runs of spaces. Empty text gives one empty token."""
    return F.split(F.trim(_single_spaces(text)), " ")


def words(body: Column) -> Column:
    # clean() has left single spaces and none at the ends
    return F.split(clean(body), " ")


def parsed_text(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def _blank_marks(tokens: Column) -> Column:
    """NULL out what must not enter an n-gram, keeping the positions."""
    return F.transform(
        tokens, lambda t: F.when(~t.isin("", *rules.PUNCTUATION_TOKENS), t)
    )


def _chain(left: Column, tokens: Column, offset: int) -> Column:
    """``left[i]_tokens[i+offset]``, NULL where either is missing."""
    later = F.slice(tokens, offset + 1, F.size(tokens))
    return F.zip_with(left, later, lambda a, b: F.concat(a, F.lit("_"), b))


def unigrams(tokens: Column) -> Column:
    return F.array_compact(_blank_marks(tokens))


def bigrams(tokens: Column) -> Column:
    """Neighbours joined by ``_``; a mark between two words parts them."""
    return _let(_blank_marks(tokens), lambda t: F.array_compact(_chain(t, t, 1)))


def trigrams(tokens: Column) -> Column:
    return _let(
        _blank_marks(tokens), lambda t: F.array_compact(_chain(_chain(t, t, 1), t, 2))
    )


def ngrams(tokens: Column) -> Column:
    """Unigrams, then bigrams, then trigrams, in one array."""

    def from_words(t: Column) -> Column:
        return _let(
            _chain(t, t, 1),
            lambda two: F.array_compact(F.concat(t, two, _chain(two, t, 2))),
        )

    return _let(_blank_marks(tokens), from_words)


def ngrams_of(tokens: Column) -> Column:
    """The n-gram array of a body's words, empty where there are none."""
    return F.coalesce(ngrams(tokens), F.array().cast("array<string>"))


def sanitize(body: Column) -> Column:
    """Body to n-gram array. A NULL body gives an empty array."""
    return ngrams_of(words(body))
