"""Language identification by unigrams over a fixed public vocabulary, summed over all segmentations.

A text is its words: runs of letters (with their marks), in lower case.  A word begins with U+2581
and has as segmentations all its cuts into vocabulary pieces, where a character that is no piece
may be its UTF-8 byte pieces.  A language is a probability for every piece; the probability
of a word is the sum over its segmentations of the products, carried by the forward
algorithm, and that of a text the product over its words.  The language with the largest posterior
(document shares as prior, ties: the smaller name) is predicted and the posterior is the score.

Learning covers all learned documents.  A Spark aggregate counts every (language, word); tasks run the
forward-backward algorithm once per distinct word and add up the expected piece counts, weighted by the word's count;
a second aggregate merges them to languages x pieces numbers.  The first round starts from equal piece probabilities,
later ones from those of the round before.  A language's probabilities are its counts, smoothed towards the
counts of all languages together.  The driver and the broadcast hold languages x pieces numbers: more than
``MAX_LANGUAGES`` different values of ``lang`` are an error, none is dropped.  A task remembers words it has scored, in
a table of bounded size that is emptied when full; that changes the time, never a score.

Defined cases: a text that is null or has no letter gets ``und`` with score 0, as does any text when no
language was learned; a null doc_id is not held out and is learned; rows without a language are not learned; very long words are
scored whole in bounded memory; repeated rows are learned and scored each; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, groupby, islice
from operator import itemgetter

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecoframe.llm.stages import Stages
from ecoframe.llm.token_counts import SPACE, default_model, read_vocabulary

WORD = r"\p{L}[\p{L}\p{M}]*"
ROUNDS = 2
PRIOR_WORDS = 200.0      # weight of the counts of all languages in a language's probabilities, in pieces
FLOOR = 0.01             # added to every piece's count of all languages together
MAX_LANGUAGES = 250
MEMORY_NUMBERS = 1_600_000   # log probabilities that a task remembers
WORDS = 50_000           # words of texts that are scored together
LONG_TEXT = 1_000_000    # texts beyond this are scored in stretches of words
STRETCH = 4_096          # characters of a long word whose matches are held
SHORT, BLOCK = 40, 2_048  # words up to this length are done together, so many at a time
UNKNOWN = "und"


def letter_pieces(pieces: list[str]) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """((piece, number) of the pieces that a word can hold, number of every byte's piece)."""
    fits = regex.compile(f"{SPACE}?[\\p{{L}}\\p{{M}}]*")
    usable = [(p, i) for i, p in enumerate(pieces) if p and fits.fullmatch(p)]
    return usable, {int(p[3:5], 16): i for i, p in enumerate(pieces) if regex.fullmatch(r"<0x[0-9A-F]{2}>", p)}


class Lattice:
    """The segmentations of words into vocabulary pieces."""

    def __init__(self, usable: list[tuple[str, int]], byte: dict[int, int]):
        self.byte, self.tree = byte, ahocorasick.Automaton()
        for piece, i in usable:
            self.tree.add_word(piece, i << 10 | len(piece))
        self.tree.make_automaton()
        self.longest = max((len(p) for p, _ in usable), default=1)
        self.single = frozenset(p for p, _ in usable if len(p) == 1)

    def found(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(end, length, piece) of all pieces in words that each begin with the space mark; none spans two words."""
        hits = chain.from_iterable(self.tree.iter(text)) if len(self.tree) else ()
        flat = np.fromiter(hits, np.int64).reshape(-1, 2)
        return flat[:, 0] + 1, flat[:, 1] & 1023, flat[:, 1] >> 10

    def spelled(self, char: str) -> list[int]:
        """The byte pieces of a character that is no piece."""
        return [self.byte[b] for b in char.encode() if b in self.byte]

    def matches(self, word: str, low: int = 0, high: int | None = None) -> Iterator[tuple[int, int, list[int]]]:
        """(start, end, pieces) with low < end <= high, by end: every piece that occurs, and the bytes of
        characters that are no piece.  Nothing is held."""
        high = len(word) if high is None else high
        first = max(0, low - self.longest + 1)
        done = low
        for at, value in self.tree.iter(word[first:high]) if len(self.tree) else ():
            end, length, i = first + at + 1, value & 1023, value >> 10
            if end > low:
                for k in range(done, end):
                    if word[k] not in self.single:
                        yield k, k + 1, self.spelled(word[k])
                done = end
                yield end - length, end, [i]
        for k in range(done, high):
            if word[k] not in self.single:
                yield k, k + 1, self.spelled(word[k])


class Block:
    """The segmentations of many words as arrays, ordered by end, for one column of probabilities a word.

    Values are plain doubles: words whose sum comes near the smallest double are done one by one."""

    LEAST = 1e-250

    def __init__(self, lattice: Lattice, words: list[str]):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        offset = np.concatenate([[0], np.cumsum(sizes)])
        text = "".join(words)
        end, length, piece = lattice.found(text)
        strange = set(text) - lattice.single
        odd = [(k + 1, lattice.spelled(c)) for k, c in enumerate(text) if c in strange] if strange else []
        # a spelled character is one match with several pieces: its weight is their product
        self.spelled = [ids for _, ids in odd]
        end = np.concatenate([end, np.array([k for k, _ in odd], dtype=np.int64)])
        length = np.concatenate([length, np.ones(len(odd), dtype=np.int64)])
        piece = np.concatenate([piece, -1 - np.arange(len(odd))])
        word = np.repeat(np.arange(len(words)), sizes)[end - 1]
        place = end - offset[word]
        order = np.argsort(place * len(words) + word, kind="stable")
        self.word, self.piece, self.end = word[order], piece[order], place[order]
        self.start = self.end - length[order]
        self.sizes, self.longest = sizes, int(sizes.max(initial=0))
        # matches of one word with one end are neighbours: where each such group begins
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (self.end[1:] != self.end[:-1]) | (self.word[1:] != self.word[:-1])
        self.groups = np.flatnonzero(fresh)
        self.cuts = np.searchsorted(self.end, np.arange(self.longest + 2))
        self.group_cuts = np.searchsorted(self.groups, self.cuts)

    def weights(self, probability: np.ndarray, column: np.ndarray | None = None) -> np.ndarray:
        """The probability of every match under all columns, or in the column of its word."""
        spelled = np.flatnonzero(self.piece < 0)
        if column is None:
            out = probability[np.maximum(self.piece, 0)]
            for at in spelled:
                out[at] = probability[self.spelled[-1 - self.piece[at]]].prod(axis=0)
            return out
        own = column[self.word]
        out = probability[np.maximum(self.piece, 0), own]
        for at in spelled:
            out[at] = probability[self.spelled[-1 - self.piece[at]], own[at]].prod()
        return out

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """alpha: summed probability of every word's beginnings (positions x words, and columns if the weights have them)."""
        alpha = np.zeros((self.longest + 1, len(self.sizes), *weights.shape[1:]))
        alpha[0] = 1.0
        for end in range(1, self.longest + 1):
            part = slice(self.cuts[end], self.cuts[end + 1])
            firsts = self.groups[self.group_cuts[end]:self.group_cuts[end + 1]]
            if len(firsts):
                ways = alpha[self.start[part], self.word[part]] * weights[part]
                alpha[end, self.word[firsts]] = np.add.reduceat(ways, firsts - part.start, axis=0)
        return alpha

    def backward(self, weights: np.ndarray) -> np.ndarray:
        """beta: summed probability of every word's rests."""
        beta = np.zeros((self.longest + 1, len(self.sizes)))
        beta[self.sizes, np.arange(len(self.sizes))] = 1.0
        for end in range(self.longest, 0, -1):
            part = slice(self.cuts[end], self.cuts[end + 1])
            np.add.at(beta, (self.start[part], self.word[part]), weights[part] * beta[end, self.word[part]])
        return beta

    def whole(self, alpha: np.ndarray) -> np.ndarray:
        return alpha[self.sizes, np.arange(len(self.sizes))]


@dataclass
class Model:
    """Learned languages: names, log priors, piece probabilities (pieces x languages)."""
    pieces: list[str]
    languages: list[str]
    prior: np.ndarray
    probability: np.ndarray


def forward(lattice: Lattice, word: str, probability: np.ndarray) -> np.ndarray:
    """Log probability of one word of any length under every column, summed over its segmentations, in logarithms.

    Only the last ``longest`` positions are kept."""
    ring = lattice.longest + 1
    alpha = np.zeros((ring, probability.shape[1]))
    for end, group in groupby(lattice.matches(word), key=itemgetter(1)):
        ways = [alpha[start % ring] + np.log(probability[ids]).sum(axis=0) for start, _, ids in group]
        alpha[end % ring] = np.logaddexp.reduce(ways, axis=0)
    return alpha[len(word) % ring]


def expected_counts(lattice: Lattice, word: str, probability: np.ndarray, times: float, total: np.ndarray) -> None:
    """Adds the expected pieces of one word of any length, under one column, ``times`` over to ``total``:
    forward-backward in logarithms, two numbers a character, its matches a stretch at a time."""
    n, log = len(word), np.log(probability)
    alpha, beta = np.zeros(n + 1), np.full(n + 1, -np.inf)
    for end, group in groupby(lattice.matches(word), key=itemgetter(1)):
        alpha[end] = np.logaddexp.reduce([alpha[start] + log[ids].sum() for start, _, ids in group])
    beta[n] = 0.0
    for low in range((n - 1) // STRETCH * STRETCH, -1, -STRETCH):
        for start, end, ids in reversed(list(lattice.matches(word, low, min(n, low + STRETCH)))):
            weight = log[ids].sum()
            beta[start] = np.logaddexp(beta[start], weight + beta[end])
            np.add.at(total, ids, times * np.exp(alpha[start] + weight + beta[end] - alpha[n]))


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def word_counts(learned: DataFrame) -> DataFrame:
    """word, lang_no, n: how often every word stands in every language, from rows (lang_no, text)."""
    words = learned.select("lang_no", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"({WORD})"), F.lit(1))).alias("word"))
    return words.groupBy("word", "lang_no").agg(F.count(F.lit(1)).alias("n"))


def log_probabilities(lattice: Lattice, words: list[str], probability: np.ndarray) -> np.ndarray:
    """`forward` of many words (rows)."""
    out = np.empty((len(words), probability.shape[1]))
    short = [k for k, w in enumerate(words) if len(w) <= SHORT]
    alone = [k for k, w in enumerate(words) if len(w) > SHORT]
    for at in range(0, len(short), BLOCK):
        part = short[at:at + BLOCK]
        block = Block(lattice, [words[k] for k in part])
        whole = block.whole(block.forward(block.weights(probability)))
        safe = whole > Block.LEAST
        out[part] = np.log(np.where(safe, whole, 1.0))
        alone += [part[k] for k in np.flatnonzero(~safe.all(axis=1))]
    for k in alone:
        out[k] = forward(lattice, words[k], probability)
    return out


def add_expected(lattice: Lattice, words: list[str], column: np.ndarray, times: np.ndarray, probability: np.ndarray,
                 total: np.ndarray) -> None:
    """Adds the expected pieces of words (each under one column of probabilities, ``times`` over) to the columns of ``total``."""
    given = column if probability.shape[1] > 1 else np.zeros_like(column)
    short = np.array([k for k, w in enumerate(words) if len(w) <= SHORT], dtype=np.int64)
    alone = [k for k, w in enumerate(words) if len(w) > SHORT]
    for at in range(0, len(short), BLOCK):
        part = short[at:at + BLOCK]
        block = Block(lattice, [words[k] for k in part])
        weights = block.weights(probability, given[part])
        alpha, beta = block.forward(weights), block.backward(weights)
        whole = block.whole(alpha)
        safe = whole > Block.LEAST
        alone += part[~safe].tolist()
        factor = np.where(safe, times[part] / np.where(safe, whole, 1.0), 0.0)
        share = alpha[block.start, block.word] * weights * beta[block.end, block.word] * factor[block.word]
        plain = block.piece >= 0
        np.add.at(total, (block.piece[plain], column[part][block.word[plain]]), share[plain])
        for k in np.flatnonzero(~plain):
            np.add.at(total[:, column[part][block.word[k]]], block.spelled[-1 - block.piece[k]], share[k])
    for k in alone:
        expected_counts(lattice, words[k], probability[:, given[k]], times[k], total[:, column[k]])


def piece_counts(counted: DataFrame, pieces: list[str], probability: np.ndarray | None, languages: int) -> np.ndarray:
    """Expected uses of every piece (rows) in every language (columns), from all counted words."""
    many = len(pieces)
    context = counted.sparkSession.sparkContext.broadcast((letter_pieces(pieces), probability))

    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, given = context.value
        lattice, total = Lattice(*parts), np.zeros((many, languages))
        if given is None:
            given = np.full((many, 1), 1.0 / many)
        for batch in batches:
            add_expected(lattice, [SPACE + w for w in batch["word"]], batch["lang_no"].to_numpy(), batch["n"].to_numpy(float), given, total)
        piece, lang = np.nonzero(total)
        yield pd.DataFrame({"piece": piece.astype("int32"), "lang_no": lang.astype("int32"), "n": total[piece, lang]})

    merged = counted.mapInPandas(expect, "piece int, lang_no int, n double").groupBy("piece", "lang_no").agg(F.sum("n").alias("n"))
    out = np.zeros((many, languages))
    rows = merged.toPandas()  # at most pieces x languages rows
    out[rows["piece"], rows["lang_no"]] = rows["n"]
    return out


def smoothed(counts: np.ndarray, prior_words: float = PRIOR_WORDS) -> np.ndarray:
    """Probabilities: a language's counts with ``prior_words`` pieces spread as in all languages together."""
    pooled = counts.sum(axis=1) + FLOOR
    return (counts + prior_words * (pooled / pooled.sum())[:, None]) / (counts.sum(axis=0) + prior_words)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rounds: int = ROUNDS,
          model_path: str | None = None) -> Model:
    """Learns every non-null language of the documents that are not held out."""
    spark = docs.sparkSession
    pieces = [p for p, _ in read_vocabulary(model_path or default_model())[0]]
    rows = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("text"), docs[id_col].alias("id"))
    rows = rows.filter(F.col("lang").isNotNull() & ~held_out(F.col("id")))
    shares = rows.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(shares) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is {lang_col} a language column?")
    names = [r["lang"] for r in shares]
    if not names:
        return Model(pieces, [], np.zeros(0), np.zeros((len(pieces), 0)))
    table = spark.createDataFrame([(name, i) for i, name in enumerate(names)], "lang string, lang_no int")
    stages = Stages(spark, "language")
    counted = stages.write(word_counts(rows.join(F.broadcast(table), "lang")), "words")  # at most MAX_LANGUAGES rows are sent
    probability = None
    for _ in range(rounds):
        probability = smoothed(piece_counts(counted, pieces, probability, len(names)))
    stages.remove("words")
    many = np.array([r["count"] for r in shares], dtype=float)
    return Model(pieces, names, np.log(many / many.sum()), probability)


class Scorer:
    """Scores texts: the state of one task."""

    def __init__(self, model: Model, memory: int | None = None):
        self.model, self.lattice = model, Lattice(*letter_pieces(model.pieces))
        self.word, self.plain_word = regex.compile(WORD), re.compile("[a-z]+")
        self.memory = memory or max(1_000, MEMORY_NUMBERS // max(1, len(model.languages)))
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        """Puts the log probabilities of new words into the table."""
        new = [w for w in words if w not in self.known]
        if not new:
            return
        if len(self.known) + len(new) > self.memory:
            self.known, self.table, new = {}, self.table[:0], list(words)
        rows = log_probabilities(self.lattice, [SPACE + w for w in new], self.model.probability)
        self.known.update(zip(new, range(len(self.table), len(self.table) + len(new))))
        self.table = np.concatenate([self.table, rows])

    def stretches(self, texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
        """(text number, some of its words in order): the words of a very long text are never held together."""
        for k, text in enumerate(texts):
            if text:
                text = text.lower()
                word = self.plain_word if text.isascii() else self.word  # the same words, found faster
                words = iter(word.findall(text)) if len(text) <= LONG_TEXT else (m.group() for m in word.finditer(text))
                while part := list(islice(words, WORDS)):
                    yield k, part

    def log_likelihoods(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Log probability of every text under every language; None without a letter."""
        out: list[np.ndarray | None] = [None] * len(texts)
        held: list[tuple[int, list[str]]] = []
        many = 0

        def settle() -> None:
            self.learn({w for _, words in held for w in words})
            for k, words in held:
                found = self.table[[self.known[w] for w in words]].sum(axis=0)
                out[k] = found if out[k] is None else out[k] + found

        for stretch in self.stretches(texts):
            held.append(stretch)
            many += len(stretch[1])
            if many >= WORDS:
                settle()
                held, many = [], 0
        settle()
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, posterior) of every text."""
        out = []
        for found in self.log_likelihoods(texts) if self.model.languages else [None] * len(texts):
            if found is None:
                out.append((UNKNOWN, 0.0))
                continue
            joint = found + self.model.prior
            best = int(joint.argmax())
            out.append((self.model.languages[best], float(1.0 / np.exp(joint - joint[best]).sum())))
        return out


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, lang_pred and score of every document."""
    context = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(context.value)
        for batch in texts:
            yield pd.DataFrame(scorer.predict(list(batch)), columns=["lang_pred", "score"])

    rows = docs.select(docs[id_col].alias("doc_id"), held_out(docs[id_col]).alias("held_out"), predict(docs[text_col]).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")
