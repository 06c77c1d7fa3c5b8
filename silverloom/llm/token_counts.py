"""Token counts under a unigram vocabulary: a Viterbi search that keeps scores and counts only."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from silverloom.llm.common import ship_code, table

BLANK = "▁"
_UNITS = re.compile(f"{BLANK}+[^{BLANK}]*").findall
#: An unknown character scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0
_WORDS = 400_000
_LONGEST_WORD = 64


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, without its control pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]


class Counter:
    """Number of tokens of a text: the best-scoring cut of each word into pieces.

    A word begins at each blank that follows no blank, and blanks are written as its first
    characters, so pieces of several blanks can match; a text has a blank in front if it does
    not begin with one. Of equal scores the longest last piece wins. A character that is no
    piece counts as its UTF-8 bytes. Scores are added from left to right, so that rounding, and
    with it every tie, falls as in a search that keeps the whole path. Only the scores and counts
    of as many places as the longest piece has characters are kept.
    """

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.machine = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.machine.add_word(piece, (len(piece), score))
        self.machine.make_automaton()
        self.span = max((len(p) for p, _ in vocabulary), default=1) + 1
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        span = self.span
        scores, counts = [0.0] * span, [0] * span
        matches = self.machine.iter(word)
        end, (size, score) = next(matches, (len(word), (0, 0.0)))
        count = 0
        for i, char in enumerate(word):
            best, count, single = None, 0, False
            while end == i:  # the longest first
                at = (i + 1 - size) % span
                value = score + scores[at]
                if best is None or value > best:
                    best, count = value, counts[at] + 1
                single = single or size == 1
                end, (size, score) = next(matches, (len(word), (0, 0.0)))
            if not single:
                value = self.unknown + scores[i % span]
                if best is None or value > best:
                    best, count = value, counts[i % span] + len(char.encode())
            scores[(i + 1) % span], counts[(i + 1) % span] = best, count
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", BLANK)
        words = _UNITS(text if text[0] == BLANK else BLANK + text)
        known, total = self.known, 0
        for word in words:
            n = known.get(word)
            if n is None:
                n = self.word(word)
                if len(word) <= _LONGEST_WORD:
                    if len(known) > _WORDS:
                        known.clear()
                    known[word] = n
            total += n
        return total


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(read_vocabulary(path))


def count_tokens(
    df: DataFrame, vocabulary: str, text: str = "text", count: str = "n_tokens"
) -> DataFrame:
    """Add the number of tokens (long) of every whole text; 0 for null and empty ones.

    Rows are counted where they are read, without a shuffle, so no key can be hot; repeated
    rows get the same count. A column named like the new one is replaced.
    """
    ship_code(df.sparkSession)
    kept = df.drop(count) if count != text else df.withColumnRenamed(text, "__text")
    source = text if count != text else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            found = [counter.count(x.as_py() or "") for x in batch.column(source)]
            columns = [*batch.columns, pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, count])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    out = kept.mapInArrow(run, ", ".join([*types, f"`{count}` long"]))
    return out if count != text else out.drop("__text")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document under the pieces and scores of a public vocabulary, read as a
    unigram model (the public files hold none of that kind)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")
