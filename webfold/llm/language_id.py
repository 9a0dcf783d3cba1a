"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built.  A text is
parsed against it from left to right into the longest phrases that occur in that text (a
letter that does not occur at all is a phrase by itself).  Ziv and Merhav's estimate of
the cross entropy is phrases * log2(size of the labelled text) / size of the
text; the language of the smallest estimate wins, the first by name among equals.
``score`` is the winner's share when each language weighs 2 to the minus
phrases * log2(size): its posterior if the estimate is read as a code length.

Letters are lower-cased and mapped to 63 symbols: the 47 most frequent of the
sample have one each, the others share 16 by their code point.  Anything else is a
border between words (symbol 0), runs of them being one.  So a transition table
has 64 columns for any script.

Learning: rows with text and a label whose id is not held out.  Of those at
most ``rows_per_language`` in expectation are drawn by a hash of the text (so copies
are one), cut into stretches of ``STRETCH`` symbols, of which the
``stretches`` smallest by hash are joined, a language's automaton in a task of its
own.  Both bounds are parameters; only learning is sampled.  An automaton is
sent as its list of transitions, about 12 bytes each and at most three a symbol,
so a language costs under ``stretches`` * 5 kB on the driver; languages are taken to
be some hundreds at most, as labels of languages are.

Scoring reads every whole text in one narrow pass.  The texts of a batch are cut into
pieces of ``PIECE`` symbols, a phrase ends with its piece, and all pieces of a
batch are parsed together, a symbol at a time, by gathers from one language's
table after another.  A task holds one table (about 25 MB) and a few MB of text.

Defined results: null texts, and texts without a letter, are ``und`` with score
0, as is every text if there is no labelled row.  A null id counts as empty text in
the held-out rule.  A label may be any non-null string; repeated rows are
scored each.  Where labels contradict each other on one text, the smallest
counts.  An empty table gives an empty result.  Columns other than the three named are
not read and may have any names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, sized, slices

SYMBOLS = 64
OWN = 47  # letters with a symbol of their own
STRETCH = 256
PIECE = 512
ROWS_PER_LANGUAGE = 2_000
STRETCHES = 200
UNKNOWN = "und"


class Automaton(NamedTuple):
    """A suffix automaton: transition ``to`` for each ``key`` = state * SYMBOLS + symbol; state 0 is the start."""

    states: int
    keys: np.ndarray
    to: np.ndarray
    size: int

    def table(self) -> np.ndarray:
        """Dense transitions; 0 where there is none (nothing leads back to the start)."""
        out = np.zeros(self.states * SYMBOLS, np.int32)
        out[self.keys] = self.to
        return out


def suffix_automaton(symbols: list[int]) -> Automaton:
    """The automaton whose paths from the start spell exactly the substrings of ``symbols``."""
    after: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        new = len(after)
        after.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in after[at]:
            after[at][symbol] = new
            at = link[at]
        if at >= 0:
            old = after[at][symbol]
            if length[old] == length[at] + 1:
                link[new] = old
            else:
                half = len(after)
                after.append(after[old].copy())
                length.append(length[at] + 1)
                link.append(link[old])
                while at >= 0 and after[at].get(symbol) == old:
                    after[at][symbol] = half
                    at = link[at]
                link[old] = link[new] = half
        last = new
    keys = np.fromiter((state * SYMBOLS + symbol for state, edges in enumerate(after) for symbol in edges), np.int32)
    to = np.fromiter((target for edges in after for target in edges.values()), np.int32)
    return Automaton(len(after), keys, to, len(symbols))


def symbol_table(letters: Counter) -> np.ndarray:
    """Symbol of each code point, given how often lower-cased letters occur: 0 for what is no letter."""
    own = {c: k for k, (c, _) in enumerate(sorted(letters.items(), key=lambda e: (-e[1], e[0]))[:OWN], 1)}
    out = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if (char := chr(point)).isalpha():
            low = char.lower()[0]
            out[point] = own.get(low) or OWN + 1 + ord(low) % (SYMBOLS - 1 - OWN)
    return out


def letters_of(texts: list[str | None]) -> Counter:
    counts = Counter()
    for text in texts:
        counts.update(text or "")
    out = Counter()
    for char, n in counts.items():
        if char.isalpha():
            out[char.lower()[0]] += n
    return out


def as_symbols(text: str | None, table: np.ndarray) -> np.ndarray:
    """Symbols of the text, one border for each stretch without letters, none at either end."""
    found = table[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = found > 0
    keep[1:] |= keep[:-1]
    found = found[keep]
    return found[:-1] if len(found) and not found[-1] else found


def phrases(table: np.ndarray, pieces: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Phrases of each piece against one automaton.  ``pieces[t]`` holds the symbols at place t, longest piece first."""
    count = np.zeros(len(lengths), np.int32)
    state = np.zeros(len(lengths), np.int32)
    active = np.searchsorted(-lengths, -np.arange(pieces.shape[0]), side="left")  # pieces longer than t
    start = table[:SYMBOLS]
    for t, n in enumerate(active.tolist()):
        if not n:
            break
        here, symbol = state[:n], pieces[t, :n]
        then = table[here * SYMBOLS + symbol]
        ends = np.flatnonzero(then == 0)
        if len(ends):
            begins = start[symbol[ends]]
            # the phrase so far ends, if there was one; a symbol that occurs nowhere is a phrase too
            count[ends] += (here[ends] > 0).astype(np.int32) + ((begins == 0) & (here[ends] > 0)) + ((begins == 0) & (here[ends] == 0))
            then[ends] = begins
        state[:n] = then
    return count + (state > 0)


class Model(NamedTuple):
    languages: list[str]
    automata: list[Automaton]
    symbols: np.ndarray

    def bits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Code length of each text (row) for each language (column), and which texts have a letter."""
        coded = [as_symbols(t, self.symbols) for t in texts]
        owner, cuts = [], []
        for k, symbols in enumerate(coded):
            for low in range(0, len(symbols), PIECE):
                owner.append(k)
                cuts.append(symbols[low:low + PIECE])
        total = np.zeros((len(texts), len(self.automata)))
        if cuts:
            lengths = np.array([len(c) for c in cuts])
            order = np.argsort(-lengths, kind="stable")
            owner, lengths = np.array(owner)[order], lengths[order]
            pieces = np.zeros((len(cuts), PIECE), np.uint8)
            for row, k in enumerate(order.tolist()):
                pieces[row, :lengths[row]] = cuts[k]
            pieces = np.ascontiguousarray(pieces.T).astype(np.int32)
            for j, automaton in enumerate(self.automata):
                count = phrases(automaton.table(), pieces, lengths)
                total[:, j] = np.bincount(owner, count, len(texts)) * np.log2(automaton.size + 1)
        return total, np.array([len(c) > 0 for c in coded], bool)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.automata or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        bits, has_letter = self.bits(texts)
        best = bits.argmin(axis=1)  # of equals the first: languages are sorted
        share = 1.0 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, has_letter)], np.where(has_letter, share, 0.0)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 0 modulo 5."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = Counter()
    for batch in slices(batches):
        total.update(letters_of(batch.column(0).to_pylist()))
    yield pa.RecordBatch.from_pydict({"letter": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})


def _stretches(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs, parts = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                symbols = as_symbols(text, table.value)
                for low in range(0, len(symbols), STRETCH):
                    langs.append(lang)
                    parts.append(symbols[low:low + STRETCH].tobytes())
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "stretch": pa.array(parts, pa.binary())})
    return run


def _built(rows: pa.Table) -> pa.Table:
    """One language's automaton, from its bounded sample."""
    parts = sorted(rows["stretch"].to_pylist())
    made = suffix_automaton([s for part in parts for s in [*part, 0]])
    return pa.table({"lang": rows["lang"][:1], "states": pa.array([made.states], pa.int32()), "keys": pa.array([made.keys.tobytes()], pa.binary()),
                     "to": pa.array([made.to.tobytes()], pa.binary()), "size": pa.array([made.size], pa.int32())})


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows_per_language: int = ROWS_PER_LANGUAGE, stretches: int = STRETCHES) -> Model:
    """Learn from labelled rows that are not held out."""
    usable = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col)).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sizes = cut(usable.groupBy("lang").agg(F.count("*").alias("n")))
    share = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    drawn = (usable.join(sized(sizes), "lang").where(share * F.col("n") < rows_per_language)
             .groupBy("text").agg(F.min("lang").alias("lang")).select("lang", "text"))
    sample = cut(drawn)
    spark = docs.sparkSession
    top = (sample.select("text").mapInArrow(_letters, "letter string, n bigint").groupBy("letter").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "letter").limit(OWN).collect())
    symbols = symbol_table(Counter({r.letter: r.n for r in top}))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("stretch"), "stretch")
    made = (sample.mapInArrow(_stretches(spark.sparkContext.broadcast(symbols)), "lang string, stretch binary").distinct()
            .withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= stretches).select("lang", "stretch")
            .groupBy("lang").applyInArrow(_built, "lang string, states int, keys binary, to binary, size int"))
    rows = sorted(made.collect(), key=lambda r: r.lang.encode())
    return Model([r.lang for r in rows], [Automaton(r.states, np.frombuffer(r["keys"], np.int32), np.frombuffer(r.to, np.int32), r["size"]) for r in rows], symbols)


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=1 << 14):
            langs, scores = model.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, held_out, lang_pred, score."""
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
            .mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(model)), f"doc_id {kind}, held_out boolean, lang_pred string, score double"))


def languages(docs: DataFrame, **learning) -> DataFrame:
    """Learn from the labelled rows of ``docs`` and tell the language of all its rows."""
    return identify(docs, train(docs, **learning))
