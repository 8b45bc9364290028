import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wattloom.llm import bpe, queries


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(queries.vocabulary())


def whole(encoder, texts):
    return [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def same(encoder, texts):
    assert [list(i) for i in encoder.encode(pa.array(texts, pa.string()))] == whole(encoder, texts)


def test_white_space_and_marks(encoder):
    same(
        encoder,
        [None, "", " ", "  ", "a  b", " a", "a ", "a   b", "a \n b", "x\n y", "\n\n a b \t c", "a  b c", "x y\n", "é è. Ça",
         "<|endoftext|> a <|endoftext|>", "it's  'll o'clock", "a\x1c b c", "日本 語  テ", "a.\nB c\n\n\nd", "a b *** c!!! d1e 2²"],
    )


@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=" \n\tabZé'.,*1ß²—語<|>", max_size=30), max_size=4))
def test_equals_whole_texts(encoder, texts):
    same(encoder, texts)


def test_store_is_bounded(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 3)
    monkeypatch.setattr(bpe, "SLICE_BYTES", 10)
    same(encoder, ["one two three four", "two three", None, "five six seven eight nine", "one"])
