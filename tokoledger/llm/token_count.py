"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary pieces that end at each position
of a word. Dynamic programming carries the best score of each position and the
number of pieces of that path, nothing else. Ties go to the path whose last
piece begins earliest, as in the tokenizers library's Unigram model; a character
that is no piece costs the lowest score less ten and counts one piece a byte.
"""

from __future__ import annotations

import math

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokoledger.llm.common import in_arrow

SPACE = "▁"          # stands for a space, at the start of each word
UNKNOWN_PENALTY = 10.0
KEPT = 400_000            # words whose count a worker remembers
KEPT_LENGTH = 64          # characters of such a word at most
BLOCK = 1 << 16           # characters of a word whose matches are held at once


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces of a sentencepiece file in their order, with Zipf log probabilities:
    -ln of the rank. The file's own scores are merge ranks and no probabilities."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), -math.log(i + 1)) for i in range(model.get_piece_size())]


class Counter(dict):
    """Word -> number of pieces; remembers a bounded number of words."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.longest = max((len(piece) for piece, _ in vocabulary), default=1)
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY

    def viterbi(self, word: str) -> int:
        """In blocks: beside the word only one block's matches and the positions that a piece can reach back to are held."""
        best, pieces, first = [0.0], [0], 0  # of the positions from ``first`` on
        for low in range(0, len(word), BLOCK):
            since = max(0, low - self.longest + 1)  # a piece may begin before the block
            ending: dict[int, list[tuple[int, float]]] = {}
            for at, found in self.automaton.iter(word[since:low + BLOCK]):  # of one end the longest piece comes first
                ending.setdefault(since + at, []).append(found)
            for end, char in enumerate(word[low:low + BLOCK], low):
                score = count = None
                for length, value in ending.get(end, ()):
                    start = end + 1 - length - first
                    candidate = value + best[start]
                    if score is None or candidate > score:
                        score, count = candidate, pieces[start] + 1
                if char not in self.single:
                    candidate = self.unknown + best[end - first]
                    if score is None or candidate > score:
                        score, count = candidate, pieces[end - first] + len(char.encode())
                best.append(score), pieces.append(count)
            gone = max(0, len(best) - self.longest)
            first += gone
            del best[:gone], pieces[:gone]
        return pieces[-1]

    def __missing__(self, word: str) -> int:
        count = self.viterbi(SPACE + word)
        if len(self) < KEPT and len(word) <= KEPT_LENGTH:
            self[word] = count
        return count

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        spaced = text.replace(" ", SPACE)
        words = (spaced if spaced.startswith(SPACE) else SPACE + spaced).split(SPACE)
        return sum(map(self.__getitem__, words[1:]))


_of_worker: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _of_worker:
        _of_worker[path] = Counter(load_vocabulary(path))
    return _of_worker[path]


def _count(path: str):
    def run(batches):
        count = counter(path).count
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([count(t.as_py()) for t in batch.column(1)], pa.int64())], ["doc_id", "n_tokens"]
            )

    return run


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens)`` for every row of ``docs`` (doc_id, text), over whole texts.
    A null or empty text has no tokens. A text without blanks is one word, of any length. Rows without a doc_id and repeated rows are
    counted like any other; further columns are not read."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return in_arrow(rows, _count(path), "doc_id long, n_tokens long")
