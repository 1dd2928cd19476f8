"""Token counts of a unigram tokenizer without building the tokens.

The text is cut into words at spaces, each led by the mark U+2581, as unigram
tokenizers do; a text that starts with neither gets one mark. In a word an Aho-Corasick automaton lists the vocabulary pieces
that end at each character, longest first; a Viterbi pass keeps, per character,
the best score and the number of pieces on the best path. Only a better score
replaces an earlier one, so ties go to the piece that starts first, which is the
tokenizer's rule. A character without a piece scores the lowest score less 10;
an unknown run costs one token per UTF-8 byte where the vocabulary has byte
pieces, else one token.

The vocabulary file is a parameter and stays outside the package. No unigram
vocabulary is among the public ones, so the query reads the pieces and scores of
``piece_bpe_32k.model`` as unigram scores; tests compare with a tokenizer library
given the same. Null and empty texts have no tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polderbook.llm.common import text_of

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words that a task remembers.
REMEMBER = 300_000


def read_vocabulary(path: str = VOCABULARY) -> tuple[list[tuple[str, float]], int]:
    """Pieces with scores, in order of id, and the id of the unknown piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(len(model))], model.unk_id()


class Counter:
    def __init__(self, vocabulary: list[tuple[str, float]], remember: int = REMEMBER):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.bytes = {f"<0x{b:02X}>" for b in range(256)} <= {p for p, _ in vocabulary}
        self.known: dict[str, int] = {}
        self.remember = remember

    def word(self, word: str) -> int:
        """Pieces on the best path of one word."""
        size = len(word)
        score = [0.0] + [None] * size
        count = [0] * (size + 1)
        unknown = [False] * (size + 1)
        matches = self.automaton.iter(word)
        held = next(matches, None)
        for end in range(size):
            best, pieces, odd, single = None, 0, False, False
            while held is not None and held[0] == end:
                length, value = held[1]
                single = single or length == 1
                start = end + 1 - length
                reached = score[start] + value
                if best is None or reached > best:
                    best, pieces, odd = reached, count[start] + 1, False
                held = next(matches, None)
            if not single:
                reached = score[end] + self.unknown
                if best is None or reached > best:
                    cost = len(word[end].encode()) if self.bytes else int(not unknown[end])
                    best, pieces, odd = reached, count[end] + cost, True
            score[end + 1], count[end + 1], unknown[end + 1] = best, pieces, odd
        return count[size]

    def text(self, text: str) -> int:
        if not text:
            return 0
        total = 0
        marked = text.replace(MARK, " ")
        for word in (marked if marked[0] == " " else f" {marked}").split(" ")[1:]:
            n = self.known.get(word)
            if n is None:
                if len(self.known) >= self.remember:
                    self.known.clear()
                n = self.word(MARK + word)
                if len(word) <= 64:
                    self.known[word] = n
            total += n
        return total


def count_tokens(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) of every row."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path)[0])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(vocabulary.value)
        for batch in batches:
            batch["n_tokens"] = [counter.text(t) for t in batch.pop("text")]
            yield batch

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text")).mapInPandas(
        counted, "doc_id string, n_tokens bigint"
    ).select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_tokens")
