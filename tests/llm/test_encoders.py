"""Both encoders against their libraries."""

import random

import numpy as np
import public_tokenizers
import pytest

from lanewright.llm import token_store
from lanewright.llm.piece_bpe import PieceModel
from lanewright.llm.token_store import Codes, WordEncoder, pack_file, unpack_file

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def odd_texts():
    rng = random.Random(1)
    letters = "ab aab  tthein  er\t\né😀ab▁xyz0aaa"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * 3000, "ab" * 2000, " " * 3000, "", "😀" * 50, "thethe" * 500, None, "x 　 y"]
    marks = "ab Éß '!.,#$%<|>-_´…“s t ll 1"
    texts += ["".join(rng.choice(marks) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    return texts + ["the end <|endoftext|> x", "é É ́a İ ΑΣ", "<s> </s> <unk> <0x41>", "a\u0000b"]


def test_pieces_equal_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model, texts = PieceModel(PIECES), odd_texts()
    mine = model.encode(texts)
    for text, ids in zip(texts, mine):
        theirs = library.encode(text or "", add_bos=True, add_eos=True)
        assert ids.tolist() == theirs
        assert model.decode(ids) == library.decode(theirs)


def test_words_equal_the_library():
    encoder, texts = WordEncoder(WORDS), odd_texts()
    mine = encoder.encode(texts)
    theirs = encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [x.tolist() for x in mine] == [e.ids for e in theirs]


def test_words_equal_the_library_past_a_full_memory(monkeypatch):
    monkeypatch.setattr(token_store, "CACHE_WORDS", 8)
    test_words_equal_the_library()


@pytest.mark.parametrize("top", [1, 200, 49408, 2**31])
def test_codes_give_any_token(top):
    ids = np.random.default_rng(0).integers(0, top, 3000).astype(np.uint32)
    codes = Codes.encode(ids)
    assert [codes[i] for i in range(3000)] == ids.tolist()
    for a, b in ((0, 3000), (17, 1801), (512, 1024), (5, 5), (2999, 3000)):
        assert codes.slice(a, b).tolist() == ids[a:b].tolist()
    doc_ids, lengths, again = unpack_file(pack_file(np.arange(2), np.array([1, 2999]), codes))
    assert again.slice(0, 3000).tolist() == ids.tolist() and lengths.tolist() == [1, 2999]
