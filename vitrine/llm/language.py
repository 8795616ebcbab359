"""Language identification by cross-parsing against labelled text.

A suffix automaton of each language's labelled text tells for any text how long a match can go on. A text is parsed
greedily into the longest phrases that occur in a language's text; the language that needs the fewest wins, where a
phrase costs the bits of naming a place in that language's text, so that languages with less text compare.

All automata are one table of next states. Texts are cut into pieces of ``PIECE`` letters that are parsed side by
side, letter by letter, in all languages at once; a phrase ends with its piece. Whole texts are parsed.

Letters are lower-cased; runs of anything but letters are one blank. Training takes texts in the order of a hash, copies
once, of each its first four times ``CHARS`` characters at most, until ``CHARS`` letters of a language are reached; this
bound is all that the driver ever holds.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, and so is every text if nothing was
learned. Ties go to the first language of the alphabet. The score is the share of the second-best language's cost
in the costs of the best two: 0.5 if they tie, 1 with one language alone. Repeated rows are judged one by one; an
empty table gives no rows. Other columns are not read, so names may clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.batches import rechunked, stored

CHARS = 20_000
TEXTS = 60
BROADCAST_ROWS = 100_000  # of a language, a hash and a number: some megabytes
PIECE = 512
TEXT_PER_BATCH = 2 << 20
UNDETERMINED = "und"


class Automaton:
    """Suffix automaton of a sequence of small numbers."""

    def __init__(self, symbols: Iterable[int]):
        self.next: list[dict[int, int]] = [{}]
        self._link, self._length, last = [-1], [0], 0
        for symbol in symbols:
            new = self._state(self._length[last] + 1, {})
            at = last
            while at >= 0 and symbol not in self.next[at]:
                self.next[at][symbol] = new
                at = self._link[at]
            if at < 0:
                self._link[new] = 0
            else:
                follows = self.next[at][symbol]
                if self._length[follows] == self._length[at] + 1:
                    self._link[new] = follows
                else:
                    copy = self._state(self._length[at] + 1, dict(self.next[follows]))
                    self._link[copy] = self._link[follows]
                    while at >= 0 and self.next[at].get(symbol) == follows:
                        self.next[at][symbol] = copy
                        at = self._link[at]
                    self._link[follows] = self._link[new] = copy
            last = new

    def _state(self, length: int, follows: dict[int, int]) -> int:
        self.next.append(follows)
        self._link.append(0)
        self._length.append(length)
        return len(self.next) - 1


class Model:
    """Automata of all languages as one table.

    ``table[state * width + symbol]`` is twice the next state, plus one if a phrase ends before the symbol. Symbol 0
    is a blank, ``width - 2`` any letter that training has not seen, ``width - 1`` fills up pieces.
    """

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        known = [plain(texts[name]) for name in self.languages]
        letters = sorted({c for text in known for c in text if c != " "})
        self.letters = {c: n + 1 for n, c in enumerate(letters)}
        self.width = len(letters) + 3
        tables, self.roots, self.bits = [], [], []
        offset = 0
        for text in known:
            states = Automaton(self.letters.get(c, 0) for c in text).next
            table = np.full((len(states), self.width), -1, np.int64)
            for number, follows in enumerate(states):
                for symbol, target in follows.items():
                    table[number, symbol] = target
            start = np.where(table[0] >= 0, table[0], 0)
            ends = table < 0
            table = np.where(ends, start[None, :], table)
            # A filler goes back to the root for nothing: the phrase before it has been counted at its start.
            table[:, -1], ends[:, -1] = 0, False
            # At the root every letter starts a phrase; elsewhere one starts where the match breaks.
            ends[0, :-1] = True
            tables.append((2 * (table + offset) + ends).astype(np.int32))
            self.roots.append(offset)
            self.bits.append(np.log2(max(2, len(text))))
            offset += len(states)
        self.table = np.concatenate(tables).ravel() if tables else np.empty(0, np.int32)
        symbols = np.zeros(0x110000, np.uint8 if self.width < 256 else np.uint16)
        other = np.array([chr(c).isalpha() for c in range(0x110000)])
        symbols[other] = self.width - 2
        for letter, number in self.letters.items():
            symbols[ord(letter)] = number
        self.symbols = symbols

    def read(self, text: str) -> np.ndarray:
        """Symbols of a text, runs of blanks as one."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        found = self.symbols[codes]
        keep = found != 0
        keep[1:] |= found[:-1] != 0
        return found[keep]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each text (rows) in each language (columns)."""
        owner = np.repeat(np.arange(len(texts)), [-(-len(t) // PIECE) for t in texts])
        pieces = np.full((len(owner), PIECE), self.width - 1, np.int64)
        row = 0
        for text in texts:
            rows = -(-len(text) // PIECE)
            pieces[row : row + rows].reshape(-1)[: len(text)] = text
            row += rows
        steps = np.ascontiguousarray(pieces.T)
        roots = np.array(self.roots, np.int64)[:, None]
        state = np.repeat(roots, len(owner), axis=1)
        counts = np.zeros(state.shape, np.int64)
        for symbols in steps:
            step = self.table.take(state * self.width + symbols)
            counts += step & 1
            state = (step >> 1).astype(np.int64)
        out = np.zeros((len(texts), len(roots)), np.int64)
        for language in range(len(roots)):
            out[:, language] = np.bincount(owner, counts[language], len(texts))
        return out

    def judge(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text."""
        read = [self.read(t) if t else np.empty(0, np.uint8) for t in texts]
        lettered = [n for n, t in enumerate(read) if t.any()]
        out = [(UNDETERMINED, 0.0)] * len(texts)
        if not lettered or not self.languages:
            return out
        costs = self.phrases([read[n] for n in lettered]) * np.array(self.bits)
        for n, cost in zip(lettered, costs):
            order = np.argsort(cost, kind="stable")
            best = cost[order[0]]
            score = float(cost[order[1]] / (best + cost[order[1]])) if len(cost) > 1 else 1.0
            out[n] = (self.languages[order[0]], score)
        return out


def plain(text: str) -> str:
    """Lower-cased letters, runs of anything else as one blank."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def learn(spark: SparkSession, documents: DataFrame, text: str, lang: str) -> dict[str, str]:
    """At most ``CHARS`` letters of text per language from at most ``TEXTS`` texts."""
    usable = documents.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    marks = usable.select(F.col(lang).alias("lang"), F.xxhash64(F.col(text)).alias("mark")).distinct()
    first = Window.partitionBy("lang").orderBy("mark")
    chosen = stored(spark, marks.withColumn("n", F.row_number().over(first)).where(F.col("n") <= TEXTS), "chosen")
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    rows = (
        usable.select(F.col(lang).alias("lang"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("text"))
        .join(chosen, ["lang", "mark"])
        .groupBy("lang", "mark")
        .agg(F.substring(F.min("text"), 1, 4 * CHARS).alias("text"), F.first("n").alias("n"))
        .select("lang", "text", "n")
        .collect()
    )
    texts: dict[str, str] = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.n)):
        texts[row.lang] = (texts.get(row.lang, "") + " " + plain(row.text))[:CHARS]
    return {name: own for name, own in texts.items() if own.strip()}


def _judged(model, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [n for n in batch.schema.names if n != "__text"]
        for part in rechunked([batch], "__text", TEXT_PER_BATCH):
            found = model.value.judge(part.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in names]
                + [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*names, "lang_pred", "score"],
            )


def identify(spark: SparkSession, documents: DataFrame, text: str, labelled: Column, lang: str, *keep: Column) -> DataFrame:
    """The ``keep`` columns of each document with lang_pred and score; learned from the rows where ``labelled``."""
    model = spark.sparkContext.broadcast(Model(learn(spark, documents.where(labelled), text, lang)))
    columns = documents.select(*keep, F.col(text).alias("__text"))
    kept = columns.drop("__text").schema
    return columns.mapInArrow(partial(_judged, model), kept.add("lang_pred", "string").add("score", "double"))
