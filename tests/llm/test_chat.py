import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm import cases
from threadmood.llm import chat

TRICKY = [
    "\\### Assistant: </turn> ok",
    "### user:\nhello\n</turn>\n",
    "\\b\\l\\h\\c \\\\ <> ##",
    "\n</turn>\n### assistant:\n",
    "",
    None,
    " spaces \n",
    "long " * 3000,
]


def conversations(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = []
    for c, roles in enumerate((["user", "assistant"], ["system", "user", "assistant"], ["assistant"], ["user", "system", "assistant"])):
        odd += [(10_000 + c, t, roles[t % len(roles)], TRICKY[t % len(TRICKY)]) for t in range(40)]
    odd += [(20_000, 0, "user", "twice")] * 2 + [(20_000, 0, "assistant", "twice")] * 2
    odd += [(20_001, None, "user", "no number"), (20_001, 3, None, "no role"), (20_001, 4, "a:\n###", "odd role"), (None, 1, "assistant", "no id")]
    odd += [(20_002, t * 1000, "assistant" if t % 2 else "user", f"turn {t} " * 30) for t in range(50)]
    rows = table.unionByName(spark.createDataFrame(odd, "conv_id long, turn long, role string, text string"))
    return rows.select(*(F.lit(f"extra {c}").alias(c) for c in cases.CLASHING if c != "text_"), "conv_id", "turn", "role", "text")


def wanted(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    return {conv: [own[2:] for own in sorted(turns)] for conv, turns in groups.items()}


def test_digests_read_back_equal_the_table(spark, sf_dir):
    rows = conversations(spark, sf_dir)
    want = wanted(rows.collect())
    windows = chat.format_windows(rows)
    found = {r["conv_id"]: r for r in cases.collected(chat.digests(chat.read_windows(windows)))}
    assert set(found) == set(want)
    chars = defaultdict(int)
    for r in windows.collect():
        chars[r.conv_id] += len(r.text)
    for conv, turns in want.items():
        own = found[conv]
        loss = "".join(text for role, text in turns if role == "assistant")
        assert own["n_turns"] == len(turns)
        assert own["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (own["loss_chars"], own["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert own["formatted_chars"] == chars[conv]


def test_windows_repeat_system_and_history_and_keep_the_budget(spark):
    turns = [("system", "be brief")] + [("assistant" if i % 2 else "user", " ".join([f"w{i}"] * 20)) for i in range(40)]
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    windows = sorted(chat.format_windows(df, budget=128, history=32).collect(), key=lambda r: r.window)
    assert len(windows) > 5
    for i, w in enumerate(windows):
        assert w.text.startswith("### system:\nbe brief\n</turn>\n")
        assert sum(len(p.split()) for p in w.text.split("\n</turn>\n")) <= 128 + 30
        assert (w.n_repeated == 0) == (i == 0)
        if i:
            assert w.n_repeated in (2, 3)  # the system turn, and one or two turns of history
        for span in w.loss:
            assert set(w.text[span.start : span.end].split()) <= {f"w{k}" for k in range(1, 40, 2)}
    targets = [w.text[s.start : s.end] for w in windows for s in w.loss]
    assert targets == [t for r, t in turns if r == "assistant"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.read_windows(chat.format_windows(df))).count() == 0
