"""Language identification by cross-parsing.

For each language a suffix automaton of sample text accepts every substring of it. A document is cut greedily into the
longest phrases that the automaton accepts; the language whose automaton needs the fewest, weighed by the logarithm of its
sample's length, wins. Letters are folded to lower case, other characters become one separator, letters that no sample holds
are phrases by themselves. The automaton is a table (state, symbol) -> state with "no phrase goes on here" as its lowest
bit, so that many stretches of text are parsed side by side in numpy. Stretches have at most `STRETCH` symbols; phrases end
at their borders, for every language alike.

Defined cases: null and letterless texts are `und` with score 0, as is everything if nothing was learned; equal costs go to
the language that comes first in code point order; equal rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm import text as T

SAMPLE_ROWS = 64  # texts learned from, for each language
SAMPLE_CHARS = 1_000  # characters taken from each of them
ALPHABET = 60
STRETCH = 512
UNKNOWN = "und"
_SEPARATOR, _OTHER, _FIRST = 0, 1, 2


def fold_table(letters: list[str]) -> np.ndarray:
    """Symbol of each code point."""
    table = np.zeros(0x110000, np.uint8)
    symbol = {letter: _FIRST + i for i, letter in enumerate(letters)}
    for point in range(0x110000):
        if 0xD800 <= point < 0xE000:
            continue
        letter = chr(point)
        if letter.isalpha():
            table[point] = symbol.get(letter.lower(), _OTHER)
    return table


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions by state of the automaton that accepts the substrings of `symbols`; 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = link[at]
        if at >= 0:
            to = moves[at][symbol]
            if length[to] == length[at] + 1:
                link[state] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and moves[at].get(symbol) == to:
                    moves[at][symbol] = copy
                    at = link[at]
                link[to] = link[state] = copy
        last = state
    return moves


def parse_table(moves: list[dict[int, int]], width: int) -> np.ndarray:
    """For state * width + symbol: twice the next state * width, plus 1 if a new phrase begins with the symbol.

    The last symbol stands for no text: it leads to the start and begins nothing. The start is left by every other symbol
    with a new phrase, since a phrase has just ended there.
    """
    begin = np.zeros(width, np.int32)
    for symbol, state in moves[0].items():
        begin[symbol] = 2 * state * width
    begin[:-1] += 1
    table = np.tile(begin, (len(moves), 1))
    for state, row in enumerate(moves[1:], 1):
        for symbol, to in row.items():
            table[state, symbol] = 2 * to * width
    return table.reshape(-1)


@dataclass
class Model:
    languages: list[str]
    letters: list[str]
    tables: list[np.ndarray]
    weights: list[float]  # bits per phrase

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_fold"}

    @property
    def fold(self) -> np.ndarray:
        if "_fold" not in self.__dict__:
            self._fold = fold_table(self.letters)
        return self._fold

    def symbols(self, part: T.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Folded symbols of a slice, the number of them before each row, and the letters by row."""
        points, bounds = code_points(part)
        symbols = self.fold[points]
        letters = np.concatenate([[0], np.cumsum(symbols != _SEPARATOR)])
        keep = symbols != _SEPARATOR
        keep[1:] |= symbols[:-1] != _SEPARATOR
        starts = bounds[:-1][bounds[:-1] < len(symbols)]
        keep[starts] = symbols[starts] != _SEPARATOR
        return symbols[keep], np.concatenate([[0], np.cumsum(keep)])[bounds], np.diff(letters[bounds])

    def phrases(self, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Number of phrases by language and row."""
        pad = _FIRST + ALPHABET
        sizes = np.diff(bounds)
        pieces = -(-sizes // STRETCH)
        row = np.repeat(np.arange(len(sizes)), pieces)
        start = bounds[:-1][row] + STRETCH * T.flat(pieces, np.zeros(len(sizes), np.int64))
        length = np.minimum(STRETCH, bounds[1:][row] - start)
        order = np.argsort(-length, kind="stable")
        row, start, length = row[order], start[order], length[order]
        open_lanes = np.searchsorted(-length, -np.arange(1, STRETCH + 1), "right")
        padded = np.append(symbols, np.uint8(pad)).astype(np.int32)
        count = np.zeros((len(self.tables), len(row)), np.int32)
        state = np.zeros((len(self.tables), len(row)), np.int32)
        for step in range(STRETCH):
            n = open_lanes[step]
            if not n:
                break
            now = padded[start[:n] + step]
            for i, table in enumerate(self.tables):
                at = state[i, :n]
                at += now
                to = table.take(at)
                count[i, :n] += to & 1
                np.right_shift(to, 1, out=at)
        out = np.zeros((len(self.tables), len(sizes)))
        for i in range(len(self.tables)):
            out[i] = np.bincount(row, count[i], len(sizes))
        return out

    def predict(self, part: T.Slice) -> tuple[list[str], np.ndarray]:
        symbols, bounds, letters = self.symbols(part)
        if not self.tables:
            return [UNKNOWN] * part.rows, np.zeros(part.rows)
        bits = self.phrases(symbols, bounds) * np.array(self.weights)[:, None]
        best = bits.argmin(axis=0)
        # bits by which the others are longer, tempered because neighbouring phrases aren't independent
        odds = np.exp2(-np.minimum((bits - bits.min(axis=0)) / 8, 1000)).sum(axis=0)
        score = np.where(letters > 0, 1 / odds, 0.0)
        return [self.languages[b] if n else UNKNOWN for b, n in zip(best, letters)], score


def code_points(part: T.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a slice and the number of them before each row; broken UTF-8 is replaced."""
    data = part.data.tobytes()
    try:
        text = data.decode("utf-8")
        before = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])[part.bounds]
    except UnicodeDecodeError:
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(part.bounds, part.bounds[1:])]
        text, before = "".join(texts), np.cumsum([0, *map(len, texts)])
    return np.frombuffer(text.encode("utf-32-le"), np.uint32), before


def train(samples: dict[str, list[str]]) -> Model:
    """A model from texts by language."""
    found: Counter[str] = Counter()
    for texts in samples.values():
        for text in texts:
            found.update(c for c in text.lower() if c.isalpha() and len(c.lower()) == 1)
    letters = sorted(sorted(found, key=lambda c: (-found[c], c))[:ALPHABET])
    model = Model([], letters, [], [])
    for language in sorted(samples):
        part = next(T.slices(pa.array([" \n".join(samples[language])]), limit=1 << 40))
        symbols, _, n = model.symbols(part)
        known = symbols[symbols != _OTHER].tolist()
        if not n[0]:
            continue
        model.languages.append(language)
        model.tables.append(parse_table(suffix_automaton(known), _FIRST + ALPHABET + 1))
        model.weights.append(math.log2(len(known) + 1))
    return model


def fit(labelled: DataFrame, *, text_column: str = "text", label_column: str = "lang", key_column: str = "doc_id",
        rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model:
    """A model from at most `rows` texts per language, `chars` characters of each, the first by a hash of the key."""
    start = F.substring(text_column, 1, chars)
    picked = labelled.where(F.col(label_column).isNotNull() & (F.length(text_column) > 0)).select(
        F.col(label_column).alias("lang"), start.alias("text"),
        F.xxhash64(key_column).alias("a"), F.xxhash64(start).alias("b"),
    )
    first = Window.partitionBy("lang").orderBy("a", "b")  # cut to `rows` per language in every task before the shuffle
    sample = picked.withColumn("n", F.row_number().over(first)).where(F.col("n") <= rows)
    texts: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", "n").collect():
        texts.setdefault(row.lang, []).append(row.text)
    return train(texts)


def identify(documents: DataFrame, model: Model, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score. The model's size depends on the languages, not on the input."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    ids = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in T.slices(batch.column(1)):
                languages, scores = model.predict(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, part.rows), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    id_type = ids.schema["doc_id"].dataType.simpleString()
    return ids.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
