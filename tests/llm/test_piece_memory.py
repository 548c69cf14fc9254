"""The word memory of the SentencePiece encoder is bounded in bytes, and its results are whole."""

from __future__ import annotations

import random

import sentencepiece

from lanewright.llm import piece_bpe
from lanewright.llm.queries import PIECE_MODEL


def _words(n: int, size: int) -> list[str]:
    rng = random.Random(n)
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzäß☃", k=size)) for _ in range(n)]


def test_long_words_fill_the_memory_by_their_bytes(monkeypatch):
    monkeypatch.setattr(piece_bpe, "CACHE_BYTES", 4_000, raising=False)
    model = piece_bpe.PieceModel(PIECE_MODEL)
    for k in range(40):
        model.encode_decode([" ".join(_words(20 + k, 60))])
    assert sum(map(len, [*model.known, *model.older])) < 20_000


def test_words_that_move_between_the_halves_are_whole(monkeypatch):
    monkeypatch.setattr(piece_bpe, "CACHE_BYTES", 2_000, raising=False)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    model = piece_bpe.PieceModel(PIECE_MODEL)
    odd = ["☃", "a\x00b", "☃x", "  two  spaces ", "▁▁mark▁", "🙂🙂", "\n\t"]
    pool = [*_words(40, 9), *odd]
    rng = random.Random(1)
    for _ in range(20):
        text = " ".join(rng.choices(pool, k=30))
        ((ids, decoded),) = model.encode_decode([text])
        own = library.encode(text, add_bos=True, add_eos=True)
        assert ids.tolist() == own and decoded == library.decode(own)
        assert model.encode([text])[0].tolist() == own
