"""Quality rules as weak supervision: rules vote or abstain, EM estimates how far to trust each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmood.llm.shared import let, stored

#: White space between words, as a set of characters and as a pattern.
SPACES = " \t\n\x0b\f\r"
SPACES_PATTERN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

ROUNDS = 20
#: Share of good documents among those no rule rejects, and among those some rule rejects, to begin with.
FIRST_GUESS = (0.95, 0.1)
#: A rule rejects at most this share of the good documents: what keeps the two classes apart as meant.
FALSE_REJECTS = 0.002
#: Rows added to every count, so that no probability is 0.
SMOOTHING = 0.5

REJECT, ABSTAIN, KEEP = -1, 0, 1


def _per_cent(part: str, whole: str, over: int, under: int) -> Column:
    """Rejects above ``over`` per cent, keeps up to ``under``, abstains between and where there is no whole."""
    part_, whole_ = F.col(part) * 100, F.col(whole)
    return F.when(whole_ == 0, ABSTAIN).when(part_ > whole_ * over, REJECT).when(part_ <= whole_ * under, KEEP).otherwise(ABSTAIN)


def rules() -> dict[str, Column]:
    """The votes over the measures of :func:`measured`."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "symbols": _per_cent("n_symbols", "n_words", 10, 2),
        "repeated_windows": _per_cent("n_repeat_words", "n_words", 20, 5),
        "repeated_lines": _per_cent("n_dup_lines", "n_lines", 40, 10),
        "echoed_words": _per_cent("n_echoes", "n_words", 20, 5),
        "capitals": _per_cent("n_upper", "word_chars", 30, 15),
        "word_length": F.when(words == 0, ABSTAIN)
        .when((chars > words * 12) | (chars < words * 2), REJECT)
        .when((chars <= words * 8) & (chars >= words * 3), KEEP)
        .otherwise(ABSTAIN),
        "diversity": F.when(words == 0, ABSTAIN)
        .when(F.col("n_distinct") * 100 <= words * 20, REJECT)
        .when(F.col("n_distinct") * 100 >= words * 50, KEEP)
        .otherwise(ABSTAIN),
        "length": F.when(words < 10, REJECT).when(words >= 20, KEEP).otherwise(ABSTAIN),
    }


def _repeat_words(words: Column) -> Column:
    """Words inside a window of five words that occurs in the list twice or more."""

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - at, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def starts(ordered: Column) -> Column:
        twice = F.filter(
            ordered,
            lambda x, i: F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(twice, lambda x: x["at"]))

    def of_hashes(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            let(ordered, lambda o: let(starts(o), covered))
        )

    def windows(own: Column) -> Column:
        first = F.sequence(F.lit(0), F.size(own) - WINDOW)
        return F.transform(first, lambda i: F.xxhash64(*(F.get(own, i + k) for k in range(WINDOW))))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW, 0).otherwise(let(let(hashes, windows), of_hashes))


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """(id, measures), and ``row``, the whole row, if wanted: counts over whole texts; NULL counts as an empty text."""
    text = F.col("text")
    spaced = lambda c: F.translate(c, SPACES, "")
    words = F.filter(F.split(text, SPACES_PATTERN), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: spaced(line) != "")
    row = [F.struct(*df.columns).alias("row")] if whole else []
    own = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *row)
    own = own.select("id", "text", words.alias("words"), lines.alias("lines"), *(["row"] if whole else []))
    echoes = let(F.col("words"), lambda w: F.size(F.filter(w, lambda x, i: F.coalesce(F.get(w, i - 1) == x, F.lit(False)))))
    return own.select(
        F.col("id").alias(id_col),
        F.size("words").cast("long").alias("n_words"),
        F.length(spaced(text)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        echoes.cast("long").alias("n_echoes"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        *(["row"] if whole else []),
    )


def posteriors(votes: DataFrame, n_rules: int, rounds: int = ROUNDS) -> DataFrame:
    """(votes, quality): probability of being good for each way to vote, by expectation-maximisation.

    A rule that does not abstain keeps or rejects with probabilities of its own for good and
    for bad documents, independently given the class; abstaining says nothing. Good documents are rejected by a rule with a
    probability of FALSE_REJECTS at most. There are at most 3 ** n_rules ways to vote, so
    after one aggregation all rounds run inside one row, over the whole corpus' counts.
    """
    counts = votes.groupBy("votes").agg(F.count("*").cast("double").alias("n"))
    ways = counts.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("ways"))
    good0, bad0 = FIRST_GUESS

    def weighed(ways: Column, quality) -> Column:
        return F.transform(ways, lambda w: F.struct(w["votes"].alias("votes"), w["n"].alias("n"), quality(w["votes"]).alias("q")))

    def total(weights: Column, term) -> Column:
        return F.aggregate(weights, F.lit(0.0), lambda sum_, w: sum_ + term(w))

    def learned(weights: Column) -> Column:
        """Logarithms: reject and keep of each rule for good, the same for bad, then both shares."""

        def chance(i: Column) -> Column:
            is_good, rule, vote = i < 2 * n_rules, F.floor(i % (2 * n_rules) / 2).cast("int"), i % 2 * 2 - 1

            def rows(w: Column) -> Column:
                return w["n"] * F.when(is_good, w["q"]).otherwise(1 - w["q"])

            cast = total(weights, lambda w: F.when(F.get(w["votes"], rule) != ABSTAIN, rows(w)).otherwise(0.0))
            hit = total(weights, lambda w: F.when(F.get(w["votes"], rule) == vote, rows(w)).otherwise(0.0))
            estimate = (hit + SMOOTHING) / (cast + 2 * SMOOTHING)
            return F.ln(F.when(is_good & (vote == REJECT), F.least(estimate, F.lit(FALSE_REJECTS))).otherwise(estimate))

        good = total(weights, lambda w: w["n"] * w["q"])
        whole = total(weights, lambda w: w["n"])
        return F.concat(
            F.transform(F.sequence(F.lit(0), F.lit(4 * n_rules - 1)), chance),
            let((good + SMOOTHING) / (whole + 2 * SMOOTHING), lambda share: F.array(F.ln(share), F.ln(1 - share))),
        )

    def quality(model: Column):
        def of(own: Column) -> Column:
            def log_chance(first: int, share: int) -> Column:
                terms = F.transform(
                    own, lambda v, j: F.when(v == ABSTAIN, 0.0).otherwise(F.get(model, j * 2 + F.when(v == KEEP, 1).otherwise(0) + first))
                )
                return F.aggregate(terms, F.get(model, F.lit(share)), lambda a, b: a + b)

            return 1 / (1 + F.exp(log_chance(2 * n_rules, 4 * n_rules + 1) - log_chance(0, 4 * n_rules)))

        return of

    first = lambda v: F.when(F.exists(v, lambda x: x == REJECT), bad0).otherwise(good0)
    start = learned(weighed(F.col("ways"), first))
    model = F.aggregate(
        F.sequence(F.lit(2), F.lit(rounds)),
        start,
        lambda model, _: let(weighed(F.col("ways"), quality(model)), learned),
    )
    final = let(model, lambda m: weighed(F.col("ways"), quality(m)))
    return ways.select(F.explode(final).alias("w")).select("w.votes", F.col("w.q").alias("quality"))


def judged(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.5,
    rounds: int = ROUNDS,
    whole: bool = False,
) -> DataFrame:
    """(id, measures, votes, base_failed, quality, kept) per row, and the whole row as ``row`` if wanted.

    ``base_failed``: under 10 words, or over 20 % of the words in repeated windows of five.
    ``kept``: not base_failed and a posterior quality of at least ``threshold``. The texts are
    read once, and what is measured is stored in the shared folder; with whole rows they are
    read once more instead of being moved or stored. Only the counts of the ways to
    vote are gathered (at most 3 ** 8 rows, a bound of the rules and not of the data, so they
    may be broadcast). NULL and empty texts have no words and fail; repeated rows and NULL ids
    are judged each; other columns are ignored; an empty table gives an empty result.
    """
    votes = rules()
    cast = F.array(*(vote.cast("int") for vote in votes.values()))
    own = stored(measured(df, id_col, text_col).withColumn("votes", cast), "quality")
    words, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (words < 10) | (repeated * 100 > words * 20)
    learned = posteriors(own, len(votes), rounds)
    if whole:
        own = measured(df, id_col, text_col, True).withColumn("votes", cast)
    return (
        own.join(F.broadcast(learned), "votes", "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("quality") >= threshold))
    )

