"""Sentence pieces against the library that defines them."""

import hashlib
import random

import pytest
from fixtures import corpus, edges, frame

from sevlab.llm import piece_codec

tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def content():
    return piece_codec.read_model(tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def model(content):
    return piece_codec.Model(content)


@pytest.fixture(scope="module")
def library(content):
    return sentencepiece.SentencePieceProcessor(model_proto=content)


def hard_texts(model) -> list[str]:
    rng = random.Random(3)
    letters = "abcdefghijklmnop  ▁\n\té中文字🙂aaaaeeee..--==  "
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rng.choices(sorted(set("".join(model.pieces))), k=rng.randint(1, 80))) for _ in range(500)]
    texts += ["".join(rng.choices(model.pieces, k=rng.randint(1, 40))).replace("▁", " ") for _ in range(1500)]
    texts += [" " * k + x for k in range(1, 40) for x in ("", "t", "the", "\n", "中")]
    return [*texts, "", "x" * 3000, "ab" * 2000, "=" * 3001, "\x00\x01\x7f", " " * 2007 + "a", "<s>hi</s><0x41><unk>", "é ﬁ　 "]


@pytest.mark.parametrize("long_segment", [2, piece_codec.LONG_SEGMENT])
def test_ids_equal_the_library(model, library, monkeypatch, long_segment):
    monkeypatch.setattr(piece_codec, "LONG_SEGMENT", long_segment)
    monkeypatch.setattr(piece_codec, "KNOWN_WORDS", 2000)
    texts, encoder, got = hard_texts(model), piece_codec.Encoder(model), []
    for start in range(0, len(texts), 300):
        ids, counts = encoder(texts[start:start + 300])
        at = 0
        for n in counts.tolist():
            got.append(ids[at:at + n].tolist())
            at += n
    assert got == library.encode(texts)
    assert [model.decode(x) for x in got] == library.decode(got)


def test_any_ids_decode_as_in_the_library(model, library):
    rng, space = random.Random(4), model.pieces.index("▁")
    lists = [[rng.randrange(len(model.pieces)) if rng.random() < 0.5 else rng.randrange(3, 259) for _ in range(rng.randint(0, 20))] for _ in range(3000)]
    lists += [[space, space, *x] for x in lists[:100]] + [[1, space, *x] for x in lists[:100]] + [[0], [0, 0, 5], [2, 1]]
    assert [model.decode(x) for x in lists] == library.decode(lists)


def test_other_models_are_refused(content):
    at = content.index(b"tok_v0")
    with pytest.raises(ValueError):
        piece_codec.Model(content[:at + 6] + bytes([3 << 3, 1]) + content[at + 8:])  # the kind of another algorithm


def test_rows_equal_the_library(spark, content, library):
    rows = corpus(60) + edges()
    got = piece_codec.round_trips(frame(spark, rows, clash=True), content).collect()
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_columns_pass_through_and_bad_bytes_are_read(spark, content, library):
    df = frame(spark, edges(), clash=True)
    encoded = piece_codec.encode(df, content)
    assert encoded.columns == [*df.columns, "ids"]
    assert piece_codec.decode(encoded, content).columns == [*df.columns, "ids", "decoded"]
    one = spark.sql("SELECT 1L AS doc_id, cast(unhex('61FF62') AS string) AS text")
    assert piece_codec.encode(one, content).first()["ids"] == library.encode("a�b")
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in piece_codec.decode(nulls, content).collect()] == ["", ""]
    empty = frame(spark, []).select("doc_id", "text")
    assert piece_codec.round_trips(empty, content).collect() == []


def test_memory_of_a_task_is_bounded(model, library):
    """Words are forgotten by their number and by their length, and slices are small: what a task holds beside the
    model stays far under an executor's memory, whatever the number of texts."""
    import tracemalloc

    rng, encoder = random.Random(9), piece_codec.Encoder(model)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=rng.randint(40, 400))) for _ in range(60)) for _ in range(900)]
    tracemalloc.start()
    for start, end in piece_codec._slices(map(len, texts), piece_codec.SLICE_CHARS):
        ids, counts = encoder(texts[start:end])
        assert encoder.chars == sum(map(len, encoder.number)) <= piece_codec.KNOWN_CHARS + 2 * piece_codec.SLICE_CHARS
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 << 20
    assert ids[:counts[0]].tolist() == library.encode(texts[start])
