"""Words that differ in case or in punctuation after them are taken to the model once; the ids stay the tokenizer's."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from millrace.llm import common, huffman, tokens
from millrace.llm.tokens import Encoder

ODD = [
    "Word word WORD", "a<|ENDOFTEXT|>b <|endoftext|> <|StartOfText|>x", "word!! word&&& wörter!? WÖRTER.", "H\u0331 h\u0331 I\u0307 \u0130 \u03a3\u03a3 \u03a3",
    "it's IT'S 's'. x'll!, 5!! 5.5%% a_b_! foo<|endoftext|>! | |> ***", "a\x85b\xa0c\xa0 \xc0\xdf\xb5!", "a!'s b.'t c''", "",
]


def calls(coder: Encoder) -> list[str]:
    """The pieces that the model and the tokenizer are asked for from now on."""
    asked: list[str] = []
    tokenize, whole = coder.tokenize, coder.whole
    coder.tokenize = lambda raw: asked.append(raw) or tokenize(raw)
    coder.whole = lambda text: asked.append(text) or whole(text)
    return asked


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_odd_texts(name):
    coder, plain = Encoder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    for t in ODD + ODD[::-1]:
        assert np.frombuffer(coder.encode(t), coder.dtype).tolist() == plain.encode(t, add_special_tokens=False).ids, t


def test_each_word_is_asked_for_once():
    words, lines = Encoder(public_tokenizers.path("word_bpe_49k.json")), Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    asked = calls(words)
    words.encode("Thonter thonter THONTER thonter!! Thonter&&&")
    assert sorted(asked) == ["!!", "&&&", "thonter"]
    asked = calls(lines)
    lines.encode("a thonter thonter!! thonter&&& thonter,")
    assert sorted(asked) == sorted(["a", "\u0120thonter", "!!", "&&&", ","])


def ids_of(coder: Encoder, texts: list[str | None]) -> list[list[int]]:
    end = np.array([7], coder.dtype).tobytes()
    column = pa.array(["cut off", *texts], pa.string()).slice(1)
    return [np.frombuffer(ids, coder.dtype).tolist() for part in coder.texts(column, end) for ids in part.to_pylist()]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("portion", [1 << 23, 40])
def test_texts_of_a_column(name, portion, monkeypatch):
    monkeypatch.setattr(tokens, "PORTION", portion)
    monkeypatch.setattr(tokens.Remembered, "LIMIT", 5)
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    texts = [*ODD, None, "", " ", "\n", "a", "a\n", "\na", "a\n\nb", "a  b", "a \n b", "Word, word.\nWord word!?\nwörd, Wörd", "x\ty \tz", *ODD]
    texts += ["\n\n<|endoftext|>b", "a <|endoftext|>\n<|endoftext|> b", "long words " * 20]
    coder = Encoder(public_tokenizers.path(name))
    for _ in range(2):
        assert ids_of(coder, texts) == [plain.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]
    assert ids_of(coder, []) == []


def test_each_word_of_a_column_is_looked_up_once(monkeypatch):
    coder, looked_up = Encoder(public_tokenizers.path("byte_bpe_50k.json")), []
    of_each = tokens.Remembered.of_each
    monkeypatch.setattr(tokens.Remembered, "of_each", lambda self, chunks: looked_up.extend(chunks) or of_each(self, chunks))
    ids_of(coder, ["a word, word. another\nword word"] * 50)
    assert sorted(looked_up) == ["", "a", "another", "word"]  # the first words of lines are remembered by themselves


def test_ids_are_counted_in_portions(monkeypatch):
    monkeypatch.setattr(huffman, "PORTION", 10)
    rows = [b"abcd", b"", b"efghijk", b"l", b""]
    assert list(huffman.portions(rows)) == [b"abcdefghijk", b"l"] and list(huffman.portions([])) == []


def test_a_worker_keeps_one_memory_at_a_time():
    path = public_tokenizers.path("word_bpe_49k.json")
    coder = tokens.encoder(path)
    ids = coder.encode("some words")
    assert common.word_hashes([b"one", b"two"]).tolist() == common.word_hashes([b"one", b"two"]).tolist()
    assert len(common._hashes) >= 2 and tokens.encoder.cache_info().currsize == 0
    common.take_up(tokens.encoder)
    assert not common._hashes and tokens.encoder(path).encode("some words") == ids
