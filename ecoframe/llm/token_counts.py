"""Token counts under a unigram vocabulary, without making the tokens.

A text is cut at blanks as the Metaspace pre-tokenizer cuts it (each part
begins with U+2581); within a part an Aho-Corasick automaton enumerates all
vocabulary matches and dynamic programming carries, for every end, the best score
and its piece count.  The tie rule is the tokenizer's: an end's first path stays unless
a later one scores strictly more, and paths come by ascending start; a character
that no piece of its own covers gets the unknown score (lowest score - 10) and, with
byte fallback, counts as its UTF-8 bytes.

The vocabulary is read from a SentencePiece model file on the driver and sent to the
tasks as a broadcast variable: the pieces and scores only, a size fixed by the
file.  Parts recur, so a task keeps counts in a table of bounded size, emptied
when full; that changes the time, never a count.

Defined cases: null and empty texts have 0 tokens; a part of any length
is counted whole; repeated rows are counted each; an empty table gives an empty
result; columns named in ``keep`` are carried.
"""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the tokenizer
MEMORY_PARTS = 400_000
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def default_model() -> str:
    """The 32k piece model among the installed public tokenizers; TOKENIZER_MODEL overrides it."""
    if given := os.environ.get("TOKENIZER_MODEL"):
        return given
    found = importlib.util.find_spec("public_tokenizers")
    folder = found.submodule_search_locations[0] if found else "/opt/tokenizers"
    return os.path.join(folder, "piece_bpe_32k.model")


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """([(piece, score)] in id order, id of the unknown piece) of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id()


class Counter:
    """Counts pieces of parts: the state of one task."""

    def __init__(self, vocabulary: list[tuple[str, float]], memory: int = MEMORY_PARTS):
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.bytes = {p for p, _ in vocabulary if len(p) == 6 and p.startswith("<0x") and p.endswith(">")}
        self.tree = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.tree.add_word(piece, (len(piece), score))
        self.tree.make_automaton()
        # With byte tokens, and no piece that has a line break, a path always cuts before and after one.
        self.cut_lines = len(self.bytes) == 256 and not any("\n" in p for p, _ in vocabulary)
        self.known: dict[str, int] = {}
        self.memory = memory

    def fallback(self, chars: str) -> int:
        """Tokens of a run of unknown characters: their bytes if all are in the vocabulary, else one unknown."""
        raw = chars.encode()
        return len(raw) if all(f"<0x{b:02X}>" in self.bytes for b in raw) else 1

    def viterbi(self, part: str) -> int:
        """Pieces on the best path through one part."""
        n, done, unknown = len(part), 0, self.unknown
        best: list = [0.0] + [None] * n
        count, run = [0] * (n + 1), [-1] * (n + 1)  # run: start of the unknown run that ends here
        alone = bytearray(n + 1)

        def close(end: int) -> None:
            """The unknown character as the last, shortest way to reach ``end``."""
            value = best[end - 1] + unknown
            if not alone[end] and (best[end] is None or value > best[end]):
                run[end] = start = run[end - 1] if run[end - 1] >= 0 else end - 1  # neighbouring unknowns are one run
                best[end], count[end] = value, count[start] + self.fallback(part[start:end])

        for last, (length, score) in self.tree.iter(part):  # ends ascend; at one end the longest match comes first
            while done < last:
                done += 1
                close(done)
            end, start = last + 1, last + 1 - length
            value = best[start] + score
            if best[end] is None or value > best[end]:
                best[end], count[end] = value, count[start] + 1
            if length == 1:
                alone[end] = 1
        while done < n:
            done += 1
            close(done)
        return count[n]

    def count(self, text: str | None) -> int:
        """Tokens of a text; white space other than blanks stays inside parts."""
        if not text:
            return 0
        total = 0
        parts = text.replace(SPACE, " ").split(" ")
        # A blank ends a part and begins the next with the space mark; so does the text, unless it begins with a blank.
        for part in parts if parts[0] else parts[1:]:
            if self.cut_lines and "\n" in part:
                first, *rest = part.split("\n")
                total += self.remembered(SPACE + first) + len(rest) + sum(map(self.remembered, rest))
            else:
                total += self.remembered(SPACE + part)
        return total

    def remembered(self, part: str) -> int:
        found = self.known.get(part)
        if found is None:
            found = self.viterbi(part)
            if len(part) <= 64:
                if len(self.known) >= self.memory:
                    self.known.clear()
                self.known[part] = found
        return found


def count_tokens(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 model_path: str | None = None) -> DataFrame:
    """Columns ``keep``, then n_tokens."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(model_path or default_model())[0])

    @F.pandas_udf("long")
    def counts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(vocabulary.value)
        for batch in texts:
            yield pd.Series([counter.count(t) for t in batch], dtype="int64")

    return docs.select(*[docs[c] for c in keep], counts(docs[text_col]).alias("n_tokens"))
