import re
from collections import Counter

import numpy as np
from odd import ODD

from viewlens.llm import quality_rules as rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {
        i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)
    }
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_counts_as_counted(spark, scratch, small_documents):
    rows = rules.judge_quality(small_documents, scratch).collect()
    texts = {r["doc_id"]: r["text"] for r in small_documents.collect()}
    for r in rows:
        counts = counted(texts[r["doc_id"]])
        assert counts == (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r["base_failed"] and r["kept"])


def test_odd_rows(documents, scratch):
    rows = rules.judge_quality(documents(ODD), scratch).collect()
    assert len(rows) == len(ODD)
    by_id = {r["doc_id"]: r for r in rows}
    for doc_id, text, _ in ODD:
        r = by_id[doc_id]
        assert counted(text) == (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert r["base_failed"] and not r["kept"] and r["word_distance"] is None
    assert rules.judge_quality(documents([]), scratch + "2").count() == 0


def test_without_reference_the_base_rules_decide(documents, scratch):
    text = " ".join(f"w{i}" for i in range(60))
    rows = rules.judge_quality(documents([(1, text, "xx"), (2, text)]), scratch).collect()
    assert all(r["kept"] and r["word_distance"] is None for r in rows)


def test_junk_goes_and_clean_stays(spark, scratch, small_documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = rules.judge_quality(small_documents, scratch).join(labels, "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.98 and (not junk or np.mean(junk) < 0.5)


def test_distance():
    one, other = np.array([[1.0, 0], [1, 1], [0, 0]]), np.array([0.0, 2])
    assert np.allclose(rules.distances(one, other)[:2], [1, 0.5579230])
    assert rules.distances(np.array([[0, 5.0]]), other)[0] == 0


def test_many_distinct_words_do_not_overflow():
    ids = np.array([0, 1, 2, 3, 0, 1, 2])
    assert rules.repeated_words(ids, 4) == rules.repeated_words(ids, 1 << 22) == 6
