import hashlib
from collections import Counter

from pyspark.sql import functions as F

from tests.llm import cases
from threadmood.llm import passages

L = passages.PASSAGE


def brute(rows):
    """{(id, text): (bytes, spans, kept)} by all 200-byte strings."""
    texts = [(row[1] or "").encode() for row in rows]
    strings = Counter(text[p : p + L] for text in texts for p in range(len(text) - L + 1))
    out = {}
    for row, text in zip(rows, texts, strict=True):
        gone = bytearray(len(text))
        for p in range(len(text) - L + 1):
            if strings[text[p : p + L]] > 1:
                gone[p : p + L] = b"\1" * L
        edges = [i for i in range(len(text) + 1) if (gone[i] if i < len(text) else 0) != (gone[i - 1] if i else 0)]
        spans = tuple(zip(edges[::2], edges[1::2], strict=True))
        out[row] = (len(text), spans, bytes(b for b, g in zip(text, gone, strict=True) if not g))
    return out


def small(spark, sf_dir):
    """Without the longest rows, which would be slow to compare by brute force."""
    docs = cases.documents(spark, sf_dir)
    return docs.where(F.coalesce(F.length("text"), F.lit(0)) <= 20_000)


def test_spans_equal_brute_force(spark, sf_dir):
    docs = small(spark, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = Counter()
    for row, own in brute(rows).items():
        want[row[0], *own] += rows.count(row)
    found = Counter(
        (r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in passages.remove_repeats(docs).collect()
    )
    assert found == want
    digests = Counter((r.doc_id, bytes(r.kept)) for r in passages.remove_repeats(docs, digest=True).collect())
    assert digests == Counter((i, hashlib.sha256(kept).digest()) for (i, _, _, kept), n in want.items() for _ in range(n))


def test_overlaps_and_lengths_around_the_limit(spark):
    unit = "".join(chr(33 + (i * i * 7 + i) % 90) for i in range(400))
    texts = [
        "ab" * 150,  # repeats itself at a distance of two
        unit[:199] + "!",
        "?" + unit[:199],
        unit[:200] + "1" + unit[300:],
        "é" + unit[:200] + "é",
        "z" * 201,
        "z" * 199,
        unit[100:350],
    ]
    rows = list(enumerate(texts))
    want = brute(rows)
    found = {r.doc_id: (tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in passages.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: own[1:] for (i, _), own in want.items()}


def test_kept_text_has_whole_characters(spark):
    shared = "é" * 100 + "passage " * 30
    rows = [(1, "è" + shared, "x"), (2, "é" + shared + "ê", "y"), (3, None, "z"), (4, "", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    found = {r.doc_id: (r.text, r.key) for r in passages.without_repeats(docs).collect()}
    assert found[3] == (None, "z") and found[4] == ("", "w")
    for _, (text, _) in found.items():
        assert text is None or text.encode().decode() == text
    assert found[2][0].endswith("ê") and "passage" not in found[2][0]


def test_every_difference_is_covered():
    pairs = {(a - b) % passages.PERIOD for a in passages.COVER for b in passages.COVER}
    assert pairs == set(range(passages.PERIOD))


def test_empty_table(spark):
    assert passages.remove_repeats(cases.empty(spark)).count() == 0
    assert passages.without_repeats(cases.empty(spark)).count() == 0
