import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from tests import literal_rules
from threadmood.functions import sql, text

# body -> words, unigrams, bigrams, trigrams; each space-joined
GOLDEN = [
    ('(well) said, "Bob"!', "well said , bob !", "well said bob", "well_said", ""),
    (
        "don't stop_now _foo_ $5 a,b",
        "don't stop_now foo 5 a,b",
        "don't stop_now foo 5 a,b",
        "don't_stop_now stop_now_foo foo_5 5_a,b",
        "don't_stop_now_foo stop_now_foo_5 foo_5_a,b",
    ),
    (
        "see [my site](http://x.com/a) and [b](www.y.org/q) ok",
        "see my and b ok",
        "see my and b ok",
        "see_my my_and and_b b_ok",
        "see_my_and my_and_b and_b_ok",
    ),
    ("very...useful thing", "thing", "thing", "", ""),
    (
        "&gt; quoted\n\nreply /s",
        "gt ; quoted reply s",
        "gt quoted reply s",
        "quoted_reply reply_s",
        "quoted_reply_s",
    ),
    ("A\rB", "ab", "ab", "", ""),
    ("é!", "!", "", "", ""),
    ("!!", "! !", "", "", ""),
    ("(", "", "", "", ""),
    ("", "", "", "", ""),
    ("a" + "!" * 101 + " b", " ".join(["a", *"!" * 101, "b"]), "a b", "", ""),
]


def collect(spark, bodies, function):
    rows = spark.createDataFrame(list(enumerate(bodies)), "i int, body string").repartition(16)
    shown = rows.select("i", function(F.col("body")).alias("out")).collect()
    return [out for _, out in sorted((r.i, r.out) for r in shown)]


@pytest.mark.parametrize(
    "column, function",
    [
        (1, text.words),
        (2, lambda b: text.unigrams(text.words(b))),
        (3, lambda b: text.bigrams(text.words(b))),
        (4, lambda b: text.trigrams(text.words(b))),
    ],
)
def test_golden(spark, column, function):
    got = collect(spark, [g[0] for g in GOLDEN], function)
    assert [" ".join(g) for g in got] == [g[column] for g in GOLDEN]


def test_golden_sanitize(spark):
    expected = [" ".join(filter(None, g[2:])).split() for g in GOLDEN]
    assert collect(spark, [g[0] for g in GOLDEN], text.sanitize) == expected


def test_empty_text_is_one_empty_token(spark):
    assert collect(spark, ["", "("], text.words) == [[""], [""]]
    assert collect(spark, ["", "("], text.sanitize) == [[], []]


def test_null_body_gives_no_tokens(spark):
    row = spark.range(1).select(text.sanitize(F.lit(None).cast("string")).alias("t")).first()
    assert row.t == []


def test_long_run_keeps_its_residue(spark):
    bodies = ["a" + "!" * n + " b" for n in (100, 101, 102, 103, 450)]
    got = collect(spark, bodies, text.words)
    assert [len(w) for w in got] == [102, 103, 102, 102, 102]
    assert [w[0] for w in got[:4]] == ["a", "a", "a!!", "a!!!"]
    assert collect(spark, bodies, text.clean) == [literal_rules.cleaned(b) for b in bodies]


def test_every_short_text(spark):
    bodies = ["".join(p) for n in range(6) for p in itertools.product("a_!$ .", repeat=n)]
    assert collect(spark, bodies, text.sanitize) == [literal_rules.sanitized(b) for b in bodies]


def test_every_short_link(spark):
    parts = ["[", "](", ")", "x", ".com", " "]
    bodies = ["".join(p) for n in range(7) for p in itertools.product(parts, repeat=n)]
    got = collect(spark, bodies, lambda b: text.remove_urls(text.spaces_for_breaks(b)))
    wrong = [(b, g) for b, g in zip(bodies, got) if g != literal_rules.without_urls(b)]
    assert not wrong[:3]


PIECES = [
    *"ab_!$.,'\\()[ ", "  ", "\n", "\r", "\t", "A", "Z9", "](", "http://", ".com", ".us", "\\*",
    "é", "\u00a0", "\u3000", "\x1c", "\x85", "\u2028", "\u0130", "\u212a", "\U0001f600", "\x00",
]


@pytest.fixture(scope="module")
def mixed():
    draw = random.Random(11)
    bodies = ["".join(draw.choices(PIECES, k=draw.randint(1, 40))) for _ in range(3000)]
    runs = ["!", "(", "!?", "-_", "! ?", "$"]
    for _ in range(200):
        bodies.append(
            "".join(
                draw.choice(["a", " ", "b c", "_"]) + draw.choice(runs) * draw.choice([1, 2, 9, 120, 230])
                for _ in range(draw.randint(1, 4))
            )
        )
    return bodies


@pytest.mark.parametrize(
    "function, literal",
    [
        (lambda b: text.remove_urls(text.spaces_for_breaks(b)), literal_rules.without_urls),
        (
            lambda b: text.split_punctuation(
                text.lowercase(text.remove_urls(text.spaces_for_breaks(b)))
            ),
            literal_rules.punctuated,
        ),
        (text.clean, literal_rules.cleaned),
        (text.sanitize, literal_rules.sanitized),
    ],
)
def test_mixed_text_equals_the_literal_rules(spark, mixed, function, literal):
    got = collect(spark, mixed, function)
    wrong = [(b, g) for b, g in zip(mixed, got) if g != literal(b)]
    assert not wrong[:3]


def test_links_on_lines_of_their_own(spark):
    """Applied to raw text, a link stays within its line."""
    body = "[a](x.com/1) and [b](y.org) c\n[d](z.net)\n(e)"
    rules = literal_rules.PLAIN[1:]
    assert collect(spark, [body], text.remove_urls) == [
        literal_rules.run(literal_rules._compiled(rules), body)
    ]


def test_sql_function_gives_the_same_tokens(spark, mixed):
    sql.register_sql_functions(spark)
    spark.createDataFrame(list(enumerate(mixed)), "i int, body string").createOrReplaceTempView("m")
    rows = spark.sql("SELECT i, sanitize(body) AS t FROM m ORDER BY i").collect()
    assert [r.t for r in rows] == [literal_rules.sanitized(b) for b in mixed]
    assert spark.sql("SELECT sanitize(NULL) AS t").first().t == []
    plan = spark.sql("SELECT sanitize(body) FROM m")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hostile_texts_take_linear_time(spark):
    n = 200_000
    bodies = [
        "a" * n,
        "[" * n + " x.com",
        "!" * n,
        "http://" * (n // 7),
        "a.com " * (n // 6),
        "x.com" + "a" * n,
        "( " * (n // 2),
        "[" + "](" * (n // 2) + " a.com",
        "[" + "](" * (n // 2) + "a.com",
        "[](" + "a.com" * (n // 5),
        "[" + "](a.com)" * (n // 8),
        "[](a.com) " * (n // 10),
    ]
    start = time.monotonic()
    collect(spark, bodies, lambda b: F.size(text.sanitize(b)))
    assert time.monotonic() - start < 60
