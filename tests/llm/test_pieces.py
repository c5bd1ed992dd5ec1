import hashlib
import random
import sys

import public_tokenizers
import pytest
import sentencepiece
from odd import ODD
from hypothesis import given, settings
from hypothesis import strategies as st

from viewlens.llm.pieces import Pieces, Remembered, token_digests, tokenize

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = open(PATH, "rb").read()
OURS, THEIRS = Pieces(MODEL), sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(text):
    ids = THEIRS.encode(text)
    assert OURS.encode(text) == ids
    assert OURS.decode(ids) == THEIRS.decode(ids) == OURS.round_trip(text)[1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(text):
    same(text)


def test_texts_of_pieces():
    rng = random.Random(5)
    for _ in range(1500):
        parts = rng.choices(OURS.texts[300:], k=rng.randint(1, 9))
        same("".join(parts).replace("▁", rng.choice([" ", "▁", ""])))
    for text in ("", " ", "  ", "\n", " \n a", "a" * 3000, "▁" * 40, "<s></s><0x0A>", "\x00é😀"):
        same(text)


def test_prefix_table_holds_last_tokens():
    part = "▁transformation"
    for end, token in enumerate(OURS.last_tokens(part), 1):
        assert OURS.encode_run(part[:end])[-1] == token


def test_remembered_is_bounded():
    kept = Remembered(lambda k: k * 2, limit=4)
    assert [kept[i] for i in range(50)] == [2 * i for i in range(50)]
    assert len(kept) <= 4 and len(kept.older) <= 4


def test_rows(documents):
    df = documents(ODD)
    rows = token_digests(df, MODEL, keep=("doc_id", "score")).collect()
    assert len(rows) == len(ODD)
    for (doc_id, text, _), row in zip(ODD, rows, strict=True):
        ids = THEIRS.encode(text or "")
        joined = ",".join(map(str, ids))
        assert (row["doc_id"], row["score"], row["n_tokens"]) == (doc_id, 1, len(ids))
        assert row["ids_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(THEIRS.decode(ids).encode()).hexdigest()
    assert [r["piece_ids"] for r in tokenize(df, MODEL).collect()][1] == []
    assert token_digests(df.limit(0), MODEL).count() == 0


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto.FromString(MODEL)
    proto.trainer_spec.model_type = 1
    with pytest.raises(ValueError, match="merge-type"):
        Pieces(proto.SerializeToString())


def random_words(seed, count, alphabet):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(1, 30))) for _ in range(count)]


def test_new_parts_are_merged_together():
    pieces = Pieces(MODEL)
    words = random_words(1, 5000, "etaoinshrdlu.É")
    calls = 0

    def count(*_):
        nonlocal calls
        calls += 1

    sys.setprofile(count)
    pieces.round_trip(" ".join(words))
    sys.setprofile(None)
    # Every call and return, from Python or C: not many for each new part.
    assert calls < 20 * len(set(words))


def test_many_texts_together(monkeypatch):
    monkeypatch.setattr("viewlens.llm.pieces.TOGETHER", 2000)
    pieces = Pieces(MODEL)
    pieces.encoded.limit = 50
    words = random_words(2, 1500, "aabcdeé ▁\n日\U0001f600*,<>0x") + ["a" * 64, "b" * 65, "é" * 300]
    texts = [None, "", *words, " ".join(words), *words[:300], None]
    found = list(pieces.round_trips(texts))
    assert len(found) == len(texts)
    for text, (numbers, back) in zip(texts, found, strict=True):
        ids = THEIRS.encode(text or "")
        assert numbers == ",".join(map(str, ids)) and back == THEIRS.decode(ids)
    assert max(map(len, pieces.encoded)) <= 64


def test_equal_scores_merge_from_the_left():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto.FromString(MODEL)
    for number, piece in enumerate(proto.pieces):
        if piece.type == 1:
            piece.score = -(number // 5000)
    changed = proto.SerializeToString()
    ours = Pieces(changed)
    theirs = sentencepiece.SentencePieceProcessor(model_proto=changed)
    for word in random_words(3, 800, "etaoinshr"):
        assert ours.encode(word) == theirs.encode(word)
