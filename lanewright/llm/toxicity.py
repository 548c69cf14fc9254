"""Toxicity scores on text restored by a noisy-channel decoder.

Channel: a writer may put a symbol for a letter, repeat letters, or put spaces
or marks between them. A word with such traces becomes a lattice of letters; a
Viterbi search finds its likeliest reading under a character trigram model,
counted over all texts. A space or mark may be dropped or end a word, so a run
of single letters splits into words; tokens that could together spell a
weighted word are also tried as one, which must be the likelier reading. The
word and all words of its reading are scored.

Score: a word and its beginnings carry log odds learned from labelled rows, as
the number of different neighbours they occur after in toxic and in clean rows,
so a passage that is copied many times counts once. A document's strongest
words go through a logistic fit.

The fit uses at most ``fit_rows`` labelled rows, those of least hash; the
character model and all scores cover every row. Labels of held-out rows are
never read; the id decides who is held out but is no input of a score, nor are
language and source.

Defined cases: null and empty texts get the score of a text without evidence;
texts of any length are scored whole; without labelled rows of both kinds every
score is the share of toxic rows among them, or 0; repeated rows get equal
scores; repeated labels of a document count as its largest; other columns are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.llm.common import CACHE_WORDS, stage, text_chunks, without_rows
from lanewright.sources.staging import Stage

FIT_ROWS = 12_000
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
LEAST_NEIGHBOURS = 3
LEAST_WEIGHT = 2.0

# Letters that a symbol may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e", "£": "l", "(": "c",
    "<": "c", "¡": "i", "&": "a", "%": "x",
}
_GAPS = ".-_*~'`,:;/\\^"
_PUNCTUATION = ".,;:!?\"'()[]{}<>*_-~`/\\"
_SYMBOLS = re.escape("".join(STANDS_FOR))
_LETTER = r"[^\W\d_]"
_EITHER = rf"(?:{_LETTER}|[{_SYMBOLS}])"
_TRACES = re.compile(
    rf"(.)\1\1|{_LETTER}[{_SYMBOLS}]+{_LETTER}|^[{_SYMBOLS}]+{_LETTER}|{_LETTER}[{re.escape('0134578@$')}]+$"
)
# Three signs with gaps between them; a word that is gapped throughout has this somewhere.
_GAPPED = re.compile(rf"{_EITHER}[{re.escape(_GAPS)}]+{_EITHER}[{re.escape(_GAPS)}]+{_EITHER}")
_IS_LETTER, _IS_EITHER = re.compile(_LETTER).search, re.compile(_EITHER).match
_IS_MARK = re.compile(r"\W").match
# Also in plain words: one gap, a doubled letter. Such a word counts beside its reading.
_SLIGHT = re.compile(rf"({_LETTER})\1|^(?=.*{_LETTER}).*{_EITHER}[{re.escape(_GAPS)}]+{_EITHER}")
# Symbols and the letters they may stand for as one sign, to find candidates quickly.
_SIGNS = str.maketrans(
    {**{c: x[0] for c, x in STANDS_FOR.items()}, "l": "i", "£": "i", "|": "i", "g": "b", "6": "b", "9": "b"}
    | dict.fromkeys(_GAPS + _PUNCTUATION.translate(str.maketrans("", "", "".join(STANDS_FOR))))
)
_REPEATS = re.compile(r"(.)\1+")

# Characters as 64 codes: 0 edge, letters, then all else.
_CODES = 64
_LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýßœ"
_TABLE = np.full(0x250, _CODES - 1, np.int32)
_TABLE[[ord(c) for c in _LETTERS if ord(c) < 0x250]] = np.arange(1, len(_LETTERS) + 1)
for _space in " \t\n\r\x0b\x0c":
    _TABLE[ord(_space)] = 0


def gapped(word: str) -> bool:
    """Whether a word is three or more letters or symbols, at least one a letter, with gaps
    between any two, and but for marks around them nothing else.

    A symbol may also be a mark at either end, so the word is read with all
    places it may be at: 0 before the first sign; 1, 3 and 5 at the first, second
    and any later sign; 2, 4 and 6 in a gap after it; 7 in the marks at the end.
    """
    if not _GAPPED.search(word) or not _IS_LETTER(word):
        return False
    at = {0}
    for c in word:
        sign, gap, mark = bool(_IS_EITHER(c)), c in _GAPS, bool(_IS_MARK(c))
        to = set()
        for k in at:
            if sign and k in (0, 2, 4, 6):
                to.add(min(k + 1, 5))
            if gap and 1 <= k <= 6:
                to.add(k + k % 2)
            if mark and k in (0, 7):
                to.add(k)
            if mark and k == 5:
                to.add(7)
        if not to:
            return False
        at = to
    return 5 in at or 7 in at


def traced(word: str) -> bool:
    """Whether a word looks disguised. Linear in its length."""
    return bool(_TRACES.search(word)) or gapped(word)


def codes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    return _TABLE[np.minimum(points, 0x24F)]


def _count_trigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(_CODES**3, np.int64)
    for batch in batches:
        for pdf in text_chunks(batch):
            c = codes_of("  " + "  ".join(t for t in pdf["text"] if t) + "  ")
            if len(c) > 2:
                counts += np.bincount((c[:-2] * _CODES + c[1:-1]) * _CODES + c[2:], minlength=_CODES**3)
    seen = np.flatnonzero(counts)
    yield pd.DataFrame({"trigram": seen, "n": counts[seen]})


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a character after two others, over all texts.

    Every task sends the trigrams of its rows; at most 64**3 sums come back.
    """
    rows = (
        docs.select("text")
        .mapInPandas(_count_trigrams, "trigram long, n long")
        .groupBy("trigram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts = np.full(_CODES**3, 0.1)
    counts[rows["trigram"].to_numpy(np.int64)] += rows["n"].to_numpy(np.float64)
    counts = counts.reshape(_CODES, _CODES, _CODES)
    return np.log(counts / counts.sum(2, keepdims=True)).astype(np.float32)


class Decoder:
    """Likeliest plain reading of a word, or of tokens with spaces between them."""

    KEEP_SYMBOL, AS_LETTER, DROP_GAP, DROP_REPEAT, GAP_ENDS_WORD = -4.0, -1.0, -0.5, -0.2, -1.0
    JOIN = -4.0  # drops the space beside a token of several letters, here a line feed
    KNOWN = 4.0  # single letters that spell a weighted word

    def __init__(self, model: np.ndarray):
        self.model = np.asarray(model, np.float64).reshape(-1).tolist()
        self.known: dict[tuple[str, bool], list[tuple[str, float, int]]] = {}

    def _options(self, c: str, repeat: bool) -> list[tuple[str, float, int]]:
        """Readings of a character with their cost and code, -1 if it is dropped."""
        options = [(x, self.AS_LETTER) for x in STANDS_FOR.get(c, "")]
        if c.isalpha():
            options.append((c, 0.0))
        elif c.isspace():
            options.append((" ", 0.0))
        else:
            options.append((c, self.KEEP_SYMBOL))
        if c in _GAPS or c.isspace():
            options.append(("", self.JOIN if c == "\n" else self.DROP_GAP))
        if c in _GAPS:
            options.append((" ", self.GAP_ENDS_WORD))
        if repeat:
            options.append(("", self.DROP_REPEAT))
        return [(x, cost, int(codes_of(x)[0]) if x else -1) for x, cost in options]

    def read(self, word: str) -> str:
        return self.read_scored(word)[0]

    def read_scored(self, word: str) -> tuple[str, float]:
        word, model, before = word.lower(), self.model, ""
        best: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
        for c in word:
            options = self.known.get((c, c == before))
            if options is None:
                options = self.known[c, c == before] = self._options(c, c == before)
            before = c
            step: dict[int, tuple[float, tuple]] = {}
            for state, (score, path) in best.items():
                for x, cost, code in options:
                    if code < 0:
                        to, value, way = state, score + cost, path
                    else:
                        to = state % _CODES * _CODES + code
                        value = score + cost + model[state * _CODES + code]
                        way = (path, x)
                    if to not in step or value > step[to][0]:
                        step[to] = (value, way)
            best = step
        state, (score, path) = max(best.items(), key=lambda e: e[1][0] + model[e[0] * _CODES])
        score += model[state * _CODES]
        out = []
        while path:
            path, x = path
            out.append(x)
        return "".join(reversed(out)), score


def plain(word: str) -> str:
    return word.strip(_PUNCTUATION)


def features(word: str) -> list[str]:
    """A word and its beginnings; beginnings end in ``*``."""
    return [word, *[word[:k] + "*" for k in PREFIXES if len(word) >= k]]


def letter_runs(words: list[str]) -> list[list[str]]:
    """Runs of three or more single letters."""
    runs, own = [], []
    for w in [*words, ".."]:
        core = plain(w) or w
        if len(core) == 1:
            own.append(core)
        else:
            if len(own) >= 3:
                runs.append(own)
            own = []
    return runs


def spaced_runs(words: list[str]) -> list[str]:
    """Runs of three or more single letters, joined."""
    return ["".join(run) for run in letter_runs(words)]


def signs(word: str) -> str:
    """A word without marks and repeats, symbols and letters alike as one sign."""
    return _REPEATS.sub(r"\1", plain(word).translate(_SIGNS))


def _all_signs(word: str) -> str:
    """Signs of all that a reading of the word may hold, its outer marks too."""
    return _REPEATS.sub(r"\1", word.translate(_SIGNS))


class _Reachable:
    """Whether any reading of a word can hold a weighted word or beginning.

    A word of a reading comes from a stretch of the characters, of which gaps and
    repeats are dropped and symbols become letters of the same sign. So its signs
    are a part of the signs of the whole, and a word in which no weighted word's
    signs are found needs no decoding: the result is the same without.
    """

    def __init__(self, weights: Iterable[str]):
        import ahocorasick

        parts = {_all_signs(f.removesuffix("*")) for f in weights}
        # Something that leaves no sign may be anywhere.
        self.always = "" in parts
        self.automaton = ahocorasick.Automaton()
        for part in parts - {""}:
            self.automaton.add_word(part, part)
        if len(self.automaton):
            self.automaton.make_automaton()

    def __call__(self, word: str) -> bool:
        if self.always or not len(self.automaton):
            return self.always
        return next(self.automaton.iter(_all_signs(word)), None) is not None


class Scorer:
    """Weights of words under a fitted model, with a bounded cache."""

    def __init__(self, weights: dict[str, float], model: np.ndarray):
        self.weights, self.decoder, self.known = weights, Decoder(model), {}
        self.whole = {signs(f) for f in weights if not f.endswith("*")}
        self.starts = {s[:k] for s in self.whole for k in range(1, len(s))}
        self.reachable = _Reachable(weights)

    def _readings(self, word: str) -> list[str]:
        own = [plain(word)]
        if self.reachable(word) and (traced(word) or _SLIGHT.search(word)):
            own.extend(map(plain, self.decoder.read(word).split()))
        return own

    def weight(self, word: str) -> float:
        """Best weight of the word's readings. Of a reading, the longest part seen counts."""
        best = 0.0
        for reading in self._readings(word):
            for f in features(reading):
                best = max(best, self.weights.get(f, 0.0))
        return best

    def _split_words(self, words: list[str]) -> dict[str, float]:
        """Weighted words that neighbouring tokens spell only together."""
        found: dict[str, float] = {}
        known = self.known
        for i in [i for i, w in enumerate(words) if known[w][2]]:
            joined = known[words[i]][1]
            for j in range(i + 1, len(words)):
                after = known[words[j]][1]
                if after[:1] == joined[-1:]:
                    after = after[1:]
                joined += after
                if joined in self.whole:
                    for word in self._joined(words, i, j + 1):
                        found[word] = self.weights[word]
                if joined not in self.starts:
                    break
        return found

    def _joined(self, words: list[str], i: int, j: int) -> list[str]:
        """Weighted words of tokens i to j read as one, if that is likelier than apart,
        with the single letters around them."""
        single = [len(plain(w) or w) == 1 for w in words[i:j]]
        a, b = i, j
        if single[0]:
            while a and len(plain(words[a - 1]) or words[a - 1]) == 1:
                a -= 1
        if single[-1]:
            while b < len(words) and len(plain(words[b]) or words[b]) == 1:
                b += 1
        inner = [" " if x and y else "\n" for x, y in zip(single, single[1:])]
        apart = "".join(x + y for x, y in zip(words[i:j], [*inner, ""]))
        before, after = " ".join([*words[a:i], ""]), " ".join(["", *words[j:b]])
        read, value = self.decoder.read_scored(before + "".join(words[i:j]) + after)
        value += sum(self.decoder.JOIN if x == "\n" else self.decoder.DROP_GAP for x in inner)
        if all(single):
            value += self.decoder.KNOWN
        own = {r for w in words[i:j] for r in self._readings(w)}
        new = [w for w in map(plain, read.split()) if w in self.weights and w not in own]
        if new and value >= self.decoder.read_scored(before + apart + after)[1] - 1e-6:
            return new
        return []

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        """Largest weight, the next largest of another word, and the sum of the top five."""
        if not text:
            return 0.0, 0.0, 0.0
        words = text.lower().split()
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        known, top = self.known, {}
        for w in set(words):
            fact = known.get(w)
            if fact is None:
                s = signs(w)
                fact = known[w] = (self.weight(w), s, s in self.starts)
            if fact[0]:
                top[w] = fact[0]
        lone = sum(1 for w in words if len(w) <= 2)
        for run in letter_runs(words) if lone >= 3 else ():
            read = {w: self.weight(w) for w in map(plain, self.decoder.read(" ".join(run)).split())}
            if not any(read.values()):
                whole = "".join(run)
                read = {whole: max(self.weight(whole), self.weight(self.decoder.read(whole)))}
            for w, value in read.items():
                if value:
                    top[w] = max(value, top.get(w, 0.0))
        for w, value in self._split_words(words).items():
            top[w] = max(value, top.get(w, 0.0))
        values = sorted(top.values(), reverse=True)[:5] + [0.0, 0.0]
        return values[0], values[1], sum(values)


def _fit_words(decoder: Decoder, word: str) -> list[str]:
    """The words that a word of a labelled row counts as."""
    own = []
    if not traced(word):
        own.append(plain(word))
        if not _SLIGHT.search(word):
            return [x for x in own if x]
    own.extend(map(plain, decoder.read(word).split()))
    return [x for x in dict.fromkeys(own) if x]


def _word_neighbours(model):
    """Words of labelled rows with the word before them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder, known = Decoder(model.value), {}
        for batch in batches:
            for pdf in text_chunks(batch):
                rows: dict[tuple[str, str, int], None] = {}
                for text, toxic in zip(pdf["text"], pdf["toxic"]):
                    before = ""
                    for w in (text or "").lower().split():
                        cores = known.get(w)
                        if cores is None:
                            if len(known) >= CACHE_WORDS:
                                known.clear()
                            cores = known[w] = _fit_words(decoder, w)
                        for core in cores:
                            rows[core, before, int(toxic)] = None
                        if cores:
                            before = cores[0]
                yield pd.DataFrame(list(rows), columns=["word", "before", "toxic"])

    return run


def fit_sample(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """At most ``fit_rows`` labelled rows that are not held out: ``text, toxic``."""
    known = (
        labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def word_weights(work: Stage, sample: DataFrame, model) -> dict[str, float]:
    """Log odds of words and beginnings that lean to toxic rows, from the fit sample."""
    toxic = F.col("toxic") == 1
    words = (
        sample.mapInPandas(_word_neighbours(model), "word string, before string, toxic int")
        .distinct()
        .groupBy("word")
        .agg(F.count_if(toxic).alias("tp"), F.count_if(~toxic).alias("fp"))
    )
    words = work.cut(words, "words")
    totals = words.agg(F.sum("tp"), F.sum("fp")).first()
    if not totals[0] or not totals[1]:
        return {}
    begins = F.array(
        *[
            F.when(F.length("word") >= k, F.concat(F.substring("word", 1, k), F.lit("*")))
            for k in PREFIXES
        ]
    )
    parts = F.explode(F.filter(F.concat(F.array("word"), begins), lambda f: f.isNotNull()))
    odds = F.log((F.col("tp") + 0.5) / F.lit(float(totals[0]))) - F.log(
        (F.col("fp") + 0.5) / F.lit(float(totals[1]))
    )
    rows = (
        words.select(parts.alias("f"), "tp", "fp")
        .groupBy("f")
        .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))
        .filter(F.col("tp") >= LEAST_NEIGHBOURS)
        .select("f", odds.alias("w"))
        .filter(F.col("w") >= LEAST_WEIGHT)
        .collect()  # bounded by the words of the fit sample
    )
    return {r["f"]: r["w"] for r in rows}


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Newton steps with a small ridge; the first coefficient is the constant."""
    z = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(z.shape[1])
    ridge = np.diag([1e-6, *[0.1] * x.shape[1]])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve(
            (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ beta
        )
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _evidence_rows(model, weights, columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(weights.value, model.value)
        for batch in batches:
            for pdf in text_chunks(batch):
                found = np.array([scorer.evidence(t) for t in pdf["text"]]).reshape(-1, 3)
                out = pdf[columns].copy()
                for k in range(3):
                    out[f"x{k}"] = found[:, k]
                yield out

    return run


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    *,
    fit_on: DataFrame | None = None,
    fit_rows: int = FIT_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    ``fit_on`` gives the labelled texts, by default ``docs`` themselves.
    """
    spark = docs.sparkSession
    work = stage(spark, "toxicity")
    model = spark.sparkContext.broadcast(character_model(docs))
    sample = work.cut(fit_sample(docs if fit_on is None else fit_on, labels, fit_rows), "sample")
    weights = spark.sparkContext.broadcast(word_weights(work, sample, model))
    fit = sample.mapInPandas(
        _evidence_rows(model, weights, ["toxic"]), "toxic int, x0 double, x1 double, x2 double"
    ).toPandas()
    y = fit["toxic"].to_numpy(float)
    if len(fit) and 0 < y.sum() < len(y):
        beta = [float(b) for b in fit_logistic(fit[["x0", "x1", "x2"]].to_numpy(float), y)]
        z = sum((F.col(f"x{k}") * b for k, b in enumerate(beta[1:])), F.lit(beta[0]))
        score = 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z))))
    else:
        score = F.lit(float(y.mean()) if len(y) else 0.0)
    found = docs.select("doc_id", "text").mapInPandas(
        _evidence_rows(model, weights, ["doc_id"]), "doc_id long, x0 double, x1 double, x2 double"
    )
    scored = found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows predicted toxic."""
    work = stage(docs.sparkSession, "toxicity-drop")

    def toxic(rows: DataFrame) -> DataFrame:
        found = score_documents(rows, labels, **{"fit_on": docs, **options})
        return found.filter("predicted = 1").select("doc_id")

    return without_rows(docs, work, toxic)
