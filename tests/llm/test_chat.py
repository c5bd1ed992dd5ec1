import hashlib

import pytest
from pyspark.sql import functions as F

from viewlens.llm import chat

TRICKY = ["", "\\", "\\.", "\\\\.", "<s>", "</s>[INST] ok [/INST]", "<</s>s>", "[[/INST]INST]",
          "<\\.s>", "é😀\n\\<s", "$1 \\1", "<", "["]


def conversations(spark, rows):
    full = [(*r, 5, "x") for r in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, window int, pos string")


def test_escape_round_trip(spark):
    df = spark.createDataFrame([(t,) for t in TRICKY], "t string")
    rows = df.select("t", chat.escape(F.col("t")).alias("e")).withColumn("u", chat.unescape(F.col("e"))).collect()
    for r in rows:
        assert r["u"] == r["t"]
        assert not any(c in r["e"] for c in (chat.TURN, chat.OPEN, chat.CLOSE, chat.END))


ROWS = (
    [(1, i, "assistant" if i % 2 else "user", f"{TRICKY[i % len(TRICKY)]} " + "word " * (i * 7 % 60)) for i in range(300)]
    + [(2, 0, "system", "be <s> kind")]
    + [(2, i, "assistant" if i % 2 == 0 else "user", "w " * 40) for i in range(1, 30)]
    + [(3, 0, "assistant", "long " * 5000), (3, 1, "user", "")]
    + [(None, None, None, None), (4, 1, "user", "same"), (4, 1, "user", "same"), (4, 1, "assistant", "same")]
)


@pytest.mark.parametrize(("budget", "history"), [(200, 50), (1024, 256), (10, 0)])
def test_windows(spark, budget, history):
    windows = chat.format_windows(conversations(spark, ROWS), budget, history)
    kept = windows.collect()
    turns = chat.read_turns(windows).orderBy("conv_id", "window", "at").collect()
    wanted = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or 0, r[2] or "", r[3] or ""))
    assert [(t["conv_id"], t["role"], t["text"]) for t in turns] == [(r[0], r[2] or "", r[3] or "") for r in wanted]
    assert all(t["loss"] == (t["text"] if t["role"] == "assistant" else None) for t in turns)
    size = lambda text: max(1, len(text.split()))
    for w in kept:
        parts = w["text"].split(chat.END)[:-1]
        texts = [p.split(chat.CLOSE, 1)[1] for p in parts]
        if w["conv_id"] == 2:
            assert parts[0].startswith("<s>[INST]system")
            assert sum(map(size, texts)) <= budget + 3 or len(parts) - w["n_repeated"] == 1
            assert sum(map(size, texts[1 : w["n_repeated"]])) <= history
    numbers = sorted(w["window"] for w in kept if w["conv_id"] == 1)
    assert numbers == list(range(len(numbers)))


def test_digests(spark):
    rows = {r["conv_id"]: r for r in chat.conversation_digests(chat.format_windows(conversations(spark, ROWS), 200, 50)).collect()}
    text = "".join(f"{r[2]}\n{r[3]}\n" for r in ROWS if r[0] == 2)
    loss = "".join(r[3] for r in ROWS if r[0] == 2 and r[2] == "assistant")
    assert rows[2]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert (rows[2]["loss_chars"], rows[2]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert rows[None]["n_turns"] == 1 and rows[4]["n_turns"] == 3 and rows[None]["loss_chars"] == 0


def test_empty_and_native(spark):
    from helpers import explain

    assert chat.format_windows(conversations(spark, [])).count() == 0
    stored = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plan = explain(chat.conversation_digests(chat.format_windows(stored)))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))
