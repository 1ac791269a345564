"""Ids by chunks against ids of whole texts."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nickmap.llm import tokens

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
TEXTS = ["", " ", "a", " a", "a ", "a  b", "a\nb", "a \n b", "\n\n", "It's we'll THE,the. x|y", "é éa ́ b", "<|endoftext|>", "a <|endoftext|> b", "x<|startoftext|>y z", "a\x1c b\x1f c", " a   b", "1234 5 67,8", "ß İ ǅ ﬁ", "日本語 テキスト", "a" * 5000, "tab\tand\r\nline", "🙂 🙂🙂", "don't can't. 's 's", "a b 　c", "É é e ́"]


def whole(e, text):
    import numpy as np

    return np.array(e.tokenizer.encode(text, add_special_tokens=False).ids, e.dtype).tobytes()


@pytest.mark.parametrize("file", FILES)
@pytest.mark.parametrize("text", TEXTS)
def test_odd_texts(file, text):
    e = tokens.encoder(tokens.tokenizer_path(file))
    assert e.ids(text) == whole(e, text)
    assert e.count(text) == len(whole(e, text)) // 2


@pytest.mark.parametrize("file", FILES)
@settings(max_examples=400, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(" \n\t'.,!stABCabcé́ \x1c5"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(file, text):
    e = tokens.encoder(tokens.tokenizer_path(file))
    assert e.ids(text) == whole(e, text)


def test_null_and_forgetting(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    e = tokens.Encoder(tokens.tokenizer_path(FILES[0]))
    assert e.ids(None) == b"" and e.count(None) == 0
    text = " ".join(f"word{i}x another{i % 4}" for i in range(40))
    assert e.ids(text) == whole(e, text) and len(e.first) <= 3
