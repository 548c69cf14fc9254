"""SentencePiece BPE in vectorised merge rounds, and its decoding.

Words of a batch lie end to end in one flat array of symbols. A round ranks all
neighbour pairs at once, takes the best pair of each word (a segmented
minimum), merges it in every word at the same time, and compacts the array;
words without a pair left drop out. Rounds end when no word has one.

A word is white space, as the meta symbol, and the letters after it. No piece
of the model joins a letter to a meta symbol after it, so words never interact;
the constructor checks this.

Within a word the library merges one pair at a time, best first, leftmost of
equals. All places of the best pair are merged in one round only where no piece
built with the merged symbol ranks before it; else the leftmost place alone.

Defined cases: null and empty texts give the begin and end ids only; characters
unknown to the model fall back to their UTF-8 bytes; texts of any length are
encoded whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from lanewright.llm.common import CACHE_WORDS, text_chunks

_META = "▁"
_NONE = np.int64(1) << 40
_SLOT_BITS = 20
# Bytes of words and their ids kept by a task before they become the older half.
CACHE_BYTES = 8_000_000
_WORD = re.compile(f"{_META}*[^{_META}]+|{_META}+")


class PieceModel:
    """Pieces and ranks read from a model file; merging and decoding are done here."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        special = np.array(
            [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(n)]
        )
        self.byte_of = {
            i: int(self.pieces[i][3:5], 16) for i in range(n) if model.is_byte(i)
        }
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.silent = {i for i in range(n) if model.is_control(i)}
        self.special = set(np.flatnonzero(special).tolist())
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        # Rank: place by falling score; equal scores keep the same rank.
        scores = np.array([model.get_score(i) for i in range(n)])
        self.rank = np.searchsorted(np.unique(-scores), -scores).astype(np.int64)
        self._build_pairs()
        if _META not in self.ids:
            raise ValueError("the model has no piece for white space")
        # Words to their ids, and of words that decode to another text that text. A full
        # memory becomes the older half; what comes again moves back.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.changed: dict[str, str] = {}
        self.size = 0

    def _build_pairs(self) -> None:
        """Every way to put a piece together from two symbols.

        A symbol is a piece or a single character; characters that are no pieces
        are numbered after the vocabulary by code point.
        """
        base, rows = len(self.pieces), []
        symbol = lambda s: self.ids.get(s, base + ord(s) if len(s) == 1 else None)
        for piece, i in self.ids.items():
            if _META in piece.lstrip(_META):
                raise ValueError("a piece reaches over a word boundary")
            for k in range(1, len(piece)):
                a, b = symbol(piece[:k]), symbol(piece[k:])
                if a is not None and b is not None:
                    rows.append((a, b, i))
        table = np.array(rows, np.int64).reshape(-1, 3)
        keys = table[:, 0] << 21 | table[:, 1]
        order = np.argsort(keys)
        self.pair_keys, self.pair_piece = keys[order], table[order, 2]
        self.pair_rank = self.rank[self.pair_piece]
        self._build_slots()
        # Best rank of any piece built from a symbol, to see where a round may merge all.
        best = np.full(base, _NONE)
        for side in (0, 1):
            own = table[:, side] < base
            np.minimum.at(best, table[own, side], self.rank[table[own, 2]])
        self.all_at_once = best > self.rank

    def _build_slots(self) -> None:
        """Two hash tables from pair keys to rows: the second takes what meets in the first."""
        odd = np.random.default_rng(0)
        rest, self.slots = np.arange(len(self.pair_keys)), []
        while len(rest):
            if len(self.slots) == 8:
                raise ValueError("pair keys do not spread")
            factor = np.uint64(int(odd.integers(1 << 63)) * 2 + 1)
            table = np.full(1 << _SLOT_BITS, -1, np.int32)
            at = self._slot(self.pair_keys[rest], factor)
            table[at] = rest
            self.slots.append((factor, table))
            rest = rest[table[at] != rest]

    @staticmethod
    def _slot(keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return ((keys.view(np.uint64) * factor) >> np.uint64(64 - _SLOT_BITS)).view(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Row of the pair table, or -1."""
        keys = left << 21 | right
        found = np.full(len(keys), -1)
        for factor, table in self.slots:
            row = table[self._slot(keys, factor)]
            same = self.pair_keys[row] == keys
            same &= row >= 0
            found[same] = row[same]
        return found

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words after all merges, end to end, and how many each word has.
        Words are not empty."""
        base = len(self.pieces)
        lengths = np.array([len(w) for w in words])
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        chars, inverse = np.unique(points, return_inverse=True)
        symbols = np.array([self.ids.get(chr(c), base + c) for c in chars], np.int64)[inverse]
        word = np.repeat(np.arange(len(words)), lengths)
        done, done_word = [], []
        while len(symbols):
            pair = np.full(len(symbols), -1)
            same = word[1:] == word[:-1]
            where = np.flatnonzero(same)
            pair[where] = self._find(symbols[where], symbols[where + 1])
            rank = np.where(pair >= 0, self.pair_rank[pair], _NONE)
            starts = np.concatenate([[0], np.flatnonzero(~same) + 1])
            sizes = np.diff(np.append(starts, len(symbols)))
            least = np.minimum.reduceat(rank, starts)
            live = least < _NONE
            over = np.repeat(~live, sizes)
            done.append(symbols[over])
            done_word.append(word[over])
            if not live.any():
                break
            chosen = np.flatnonzero((rank == np.repeat(least, sizes)) & (pair >= 0))
            merged = self.pair_piece[pair[chosen]]
            first = np.append(True, word[chosen[1:]] != word[chosen[:-1]])
            # The leftmost place fixes the pair; others of the same pair follow where
            # they may, and of overlapping places every second one.
            lead = np.maximum.accumulate(np.where(first, np.arange(len(chosen)), 0))
            take = first | ((pair[chosen] == pair[chosen[lead]]) & self.all_at_once[merged])
            chosen, merged, first = chosen[take], merged[take], first[take]
            touches = np.append(False, (chosen[1:] == chosen[:-1] + 1)) & ~first
            run = np.arange(len(chosen)) - np.maximum.accumulate(
                np.where(touches, 0, np.arange(len(chosen)))
            )
            even = run % 2 == 0
            chosen, merged = chosen[even], merged[even]
            symbols[chosen] = merged
            keep = ~over
            keep[chosen + 1] = False
            symbols, word = symbols[keep], word[keep]
        places = np.concatenate(done_word)
        order = np.argsort(places, kind="stable")
        return np.concatenate(done)[order], np.bincount(places, minlength=len(words))

    def encode_words(self, words: list[str]) -> None:
        """Put the ids and the text of new words into the cache."""
        base = len(self.pieces)
        symbols, lengths = self.merge(words)
        ends = np.cumsum(lengths)
        foreign = np.flatnonzero(symbols >= base)
        odd = dict.fromkeys(np.searchsorted(ends, foreign, side="right").tolist())
        packed, listed = symbols.astype("<u4").tobytes(), symbols.tolist()
        a = 0
        for k, (word, b) in enumerate(zip(words, ends.tolist())):
            ids, data = listed[a:b], packed[4 * a : 4 * b]
            if k in odd:
                own: list[int] = []
                for s in ids:
                    if s < base:
                        own.append(s)
                    else:
                        raw = chr(s - base).encode("utf-8", "replace")
                        own.extend(self.byte_id.get(c, self.unknown) for c in raw)
                ids, data = own, np.array(own, "<u4").tobytes()
            self.known[word] = data
            self.size += len(word) + len(data)
            text = self._text(ids)
            if text != word.replace(_META, " "):
                self.changed[word] = text
            a = b

    def _words(self, texts: list[str | None]) -> list[list[str]]:
        """Words of each text, all of them known."""
        if len(self.known) >= CACHE_WORDS // 2 or self.size >= CACHE_BYTES:
            self.known, self.older, self.size = {}, self.known, 0
            self.changed = {w: t for w, t in self.changed.items() if w in self.older}
        split = [_WORD.findall(_META + t.replace(" ", _META)) if t else [] for t in texts]
        missing = {w for words in split for w in words} - self.known.keys()
        again = missing & self.older.keys()
        for w in again:
            data = self.known[w] = self.older.pop(w)
            self.size += len(w) + len(data)
        new = list(missing - again)
        at = size = 0
        for k, w in enumerate(new, 1):
            size += len(w)
            if size >= 200_000 or k == len(new):
                self.encode_words(new[at:k])
                at, size = k, 0
        return split

    def encode_decode(self, texts: list[str | None]) -> list[tuple[np.ndarray, str]]:
        """Ids of whole texts with the begin and end ids, and the text they decode to.

        A word starts with a piece of the model, so no run of byte ids reaches into
        it, and its ids decode to the same text wherever it stands.
        """
        begin, end = np.array([self.begin], "<u4").tobytes(), np.array([self.end], "<u4").tobytes()
        split = self._words(texts)
        get, changed, out = self.known.__getitem__, self.changed, []
        for words in split:
            ids = np.frombuffer(begin + b"".join(map(get, words)) + end, "<u4")
            if not changed.keys().isdisjoint(words):
                words = [changed.get(w, w) for w in words]
            out.append((ids, "".join(words).replace(_META, " ")[1:]))
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of whole texts with the begin and end ids."""
        begin, end = np.array([self.begin], "<u4").tobytes(), np.array([self.end], "<u4").tobytes()
        split = self._words(texts)
        get = self.known.__getitem__
        return [
            np.frombuffer(begin + b"".join(map(get, words)) + end, "<u4") for words in split
        ]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids. Control ids are silent, the unknown id gives the
        library's mark, runs of byte ids are UTF-8, and the space that encoding
        put before the text goes."""
        values = ids.tolist()
        text = self._text(values)
        first = next((i for i in values if i not in self.silent), None)
        lead = first is not None and first not in self.special and self.pieces[first].startswith(_META)
        return text[1:] if lead else text

    def _text(self, values: list[int]) -> str:
        if self.special.isdisjoint(values):
            return "".join([self.pieces[i] for i in values]).replace(_META, " ")
        parts, raw = [], bytearray()
        for i in [*values, self.end]:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                parts.append(_utf8(bytes(raw)))
                raw.clear()
            if i == self.unknown:
                parts.append(" ⁇ ")
            elif i not in self.silent:
                parts.append(self.pieces[i].replace(_META, " "))
        return "".join(parts)


def _utf8(raw: bytes) -> str:
    """Each byte that is no part of a character becomes one replacement character."""
    out = []
    while raw:
        try:
            return "".join(out) + raw.decode()
        except UnicodeDecodeError as error:
            out.append(raw[: error.start].decode() + "�")
            raw = raw[error.start + 1 :]
    return "".join(out)


def piece_digest(docs: DataFrame, *, model_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = PieceModel(model_path)
        for batch in batches:
            for pdf in text_chunks(batch):
                done = model.encode_decode(list(pdf["text"]))
                yield pd.DataFrame(
                    {
                        "doc_id": pdf["doc_id"],
                        "n_tokens": [len(x) for x, _ in done],
                        "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x, _ in done],
                        "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for _, t in done],
                    }
                )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInPandas(run, schema)


def encode_documents(docs: DataFrame, *, model_path: str) -> DataFrame:
    """``doc_id, ids`` with whole texts encoded."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = PieceModel(model_path)
        for batch in batches:
            for pdf in text_chunks(batch):
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": model.encode(list(pdf["text"]))})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, ids array<int>")
